"""Pieces that several operators share: words, staged tables, Arrow batch sizes."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.session import stage, unstage  # noqa: F401  used by the operators

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: str | Column) -> Column:
    """The words of a text in order; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Texts may be long: hand Python few rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


FEW_KEYS = 200_000  # keys that are sent to every task; more are joined by shuffle


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def content_hash(df: DataFrame, salt: int = 0) -> Column:
    """64 bits of a row's whole content; equal rows have equal ones."""
    return F.xxhash64(F.lit(salt), *[df[f"`{c}`"] for c in df.columns])


def without(df: DataFrame, gone: DataFrame, *keys: Column) -> DataFrame:
    """The rows whose ``keys`` equal no row of the staged table ``gone``; it travels if it is small."""
    names = [fresh_name(df, f"_gone{i}") for i in range(len(keys))]
    gone = gone.toDF(*names)
    if gone.count() <= FEW_KEYS:
        gone = F.broadcast(gone)
    equal = F.lit(True)
    for name, key in zip(names, keys):
        equal = equal & (key == F.col(name))
    return df.join(gone, equal, "left_anti")
