"""Exact row numbers and running counts that never put one hot group into one task."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import stage


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null equal to null; the keys of the left side stay."""
    right = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    equal = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_r_{key}")) for key in keys])
    return left.join(right, equal, how).drop(*[f"_r_{key}" for key in keys])


def running_sum(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out`` = sum of ``value`` over the rows of the group up to this one, in ``order``.

    Ranges as in ``number_rows``: each is summed on its own and shifted by the sums of those
    before it. Rows equal in all of ``order`` are summed in any order. Null keys form a group.
    """
    ranged = stage(df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()), "running")
    keys = [*group, "_range"]
    before = Window.partitionBy(*(group or [F.lit(1)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = (ranged.groupBy(*keys).agg(F.sum(value).alias("_n"))
             .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return (same_keys(ranged.withColumn("_inside", inside), shift, keys)
            .withColumn(out, F.col("_inside") + F.col("_shift")).drop("_inside", "_shift", "_range"))


def number_rows(df: DataFrame, group: list[str], order: list[str | Column], out: str = "rn") -> DataFrame:
    """Add ``out`` = 1-based position of each row in its group, ordered by ``order``.

    The rows are dealt to ranges of (group, order) and written with the number of their
    range, so a group with a third of all rows, or with one value in the first order column,
    takes a third of the ranges. Each range is numbered on its own and shifted by the counts
    of the ranges before it. ``order`` should be total: rows equal in all of it are numbered
    in any order, and only such rows share a range without limit. Null keys form a group.
    """
    ranged = stage(df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()),
                   "numbering")
    keys = [*group, "_range"]
    # one row for each range that a group reaches into
    before = Window.partitionBy(*(group or [F.lit(1)])).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    shift = (ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .drop("_n"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (same_keys(ranged.withColumn("_inside", inside), shift, keys)
            .withColumn(out, F.col("_inside") + F.col("_shift"))
            .drop("_inside", "_shift", "_range"))
