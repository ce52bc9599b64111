"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly."""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import documents, stage, word_count
from pagewright.operators.numbering import number_rows

SHARDS = 16
CELL_UNITS = 50_000   # groups that one task places
SPLIT_SHARE = 0.5     # a group above this share of a shard, in any measure, is split
HEAVY_SHARE = 1 / 64  # a unit above this share of a shard is placed before all others
KEY = ["g", "crc", "size"]


def place(vectors: np.ndarray, room: np.ndarray) -> np.ndarray:
    """A shard for each vector in turn: the one whose remaining room has the highest dot
    product with it. ``room`` is (shards, measures) and is used up in place."""
    out = np.empty(len(vectors), dtype=np.int32)
    for i, vector in enumerate(vectors):
        out[i] = shard = int(np.argmax(room @ vector))
        room[shard] -= vector
    return out


def _shares(totals, shards: int):
    """The largest share of one shard's room that a unit takes, over the three measures."""
    return F.greatest(*[F.col(c) * shards / F.lit(max(totals[c], 1)) for c in ("bytes", "tokens", "rows")])


def assign(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
           cell_units: int = CELL_UNITS) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes plus 1), text_crc32, tokens (words),
    shard and slot (0, 1, ... within the shard).

    Documents of one text form a group and stay together, unless the group takes over half a
    shard's room in bytes, tokens or rows: such a group is cut row by row, whatever the ids, into
    units of about an eighth of a shard. At most 3 * 2 * shards groups and 3 * 64 * shards units can
    be so large, which bounds what is broadcast and what the driver places first. All other
    units are hashed to cells of about ``cell_units``; each cell places its units, largest
    first, into its share of the room that is left, so every cell is level by itself.

    A null text has no bytes and is a group of its own; rows with equal ids or none are placed
    like others and take neighbouring slots in any order; an empty table gives no rows. Only
    these columns are returned, so names of other columns cannot clash.
    """
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("g"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        word_count(text).alias("tokens"), F.xxhash64(F.monotonically_increasing_id()).alias("row"))
    slim = stage(keyed, "shard-rows")
    totals = slim.agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                      F.count(F.lit(1)).alias("rows")).first().asDict()
    totals = {name: n or 0 for name, n in totals.items()}

    def units(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                       F.count(F.lit(1)).alias("rows")).withColumn("share", _shares(totals, shards))

    large = (units(slim, KEY).where(F.col("share") > SPLIT_SHARE)
             .select(*KEY, F.ceil(F.col("share") * 8).alias("cuts")))
    slim = (slim.join(F.broadcast(large), KEY, "left")
            .withColumn("cut", F.coalesce(F.pmod("row", "cuts"), F.lit(0))).drop("cuts"))
    key = [*KEY, "cut"]
    unit = stage(units(slim, key), "shard-units")

    scale = np.array([max(totals[c], 1) for c in ("bytes", "tokens", "rows")], dtype=float)
    heavy = unit.where(F.col("share") > HEAVY_SHARE).orderBy(F.desc("share"), *key).toPandas()
    room = np.full((shards, 3), 1 / shards)
    heavy["shard"] = place(heavy[["bytes", "tokens", "rows"]].to_numpy(float) / scale, room)
    left = np.maximum(room, 0)
    left /= np.maximum(left.sum(axis=0), 1e-12)

    light = unit.where(F.col("share") <= HEAVY_SHARE)
    cells = max(1, math.ceil(light.count() / cell_units))

    def fill(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["bytes", *key], ascending=False, ignore_index=True)
        vectors = cell[["bytes", "tokens", "rows"]].to_numpy(float) / scale
        cell["shard"] = place(vectors, left * vectors.sum(axis=0))
        return cell[[*key, "shard"]]

    schema = "g long, crc long, size long, cut long, shard int"
    placed = (light.withColumn("cell", F.pmod(F.xxhash64(*key, F.lit(3)), F.lit(cells)))
              .groupBy("cell").applyInPandas(fill, schema))
    if len(heavy):
        placed = placed.unionByName(slim.sparkSession.createDataFrame(
            [[int(v) for v in row] for row in heavy[[*key, "shard"]].to_numpy()], schema))
    dealt = slim.join(placed, key)
    return (number_rows(dealt, ["shard"], ["doc_id", "crc", "size", "row"])
            .select("doc_id", "size", F.col("crc").alias("text_crc32"), "tokens", "shard",
                    (F.col("rn") - 1).alias("slot")))


def shard_files(docs: DataFrame, folder: str, **options) -> None:
    """Write the documents as ``folder``/shard=N; ids must be unique."""
    key = options.get("doc_id", "doc_id")
    where = assign(docs, **options).select(F.col("doc_id").alias(key), "shard")
    docs.join(where, key).write.partitionBy("shard").parquet(folder)


def op3_sharding(spark, sf_dir):
    return assign(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"), "tokens")
