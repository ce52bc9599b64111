"""Roll-ups over spaces, items, attachments and results."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.text import col
from pagewright.operators.attachments import statistics
from pagewright.operators.numbering import number_rows


def percent(part, total) -> Column:
    """Percentage, 0 for an empty total."""
    return F.when(col(total) > 0, col(part) / col(total) * 100).otherwise(0.0)


def cleaning_summary(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("error").isNull()).alias("processed"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.sum(F.when(F.col("error").isNull(), F.col("original_size") - F.col("cleaned_size")))
        .alias("size_reduction"))


def space_summary(spaces: DataFrame, items: DataFrame) -> DataFrame:
    counts = items.groupBy("space_key").agg(
        F.count(F.lit(1)).alias("total_items"), F.count_if(F.size("path") == 1).alias("root_items"))
    return (spaces.join(counts, "space_key", "left").na.fill(0, ["total_items", "root_items"])
            .withColumn("description", F.coalesce("description", F.lit(""))))


def upload_status(items: DataFrame, spaces: DataFrame | None = None) -> DataFrame:
    """Per space: created, total, percentage and whether everything is created.

    With ``spaces`` also their upload time and collection id, and a row of zeros for spaces
    without items.
    """
    counts = items.groupBy("space_key").agg(
        F.count_if(F.col("created")).alias("created_items"), F.count(F.lit(1)).alias("total_items"))
    if spaces is not None:
        counts = (spaces.select("space_key", "uploaded_at", "collection_id").join(counts, "space_key", "left")
                  .na.fill(0, ["created_items", "total_items"]))
    return (counts.withColumn("completion_percentage", percent("created_items", "total_items"))
            .withColumn("upload_successful", F.col("created_items") == F.col("total_items")))


def status_report(spaces: DataFrame, items: DataFrame, details: DataFrame) -> DataFrame:
    """One row per space; attachment counts only where there are attachments."""
    att = statistics(details).select("space_key", "total_attachments", "uploaded_attachments",
                                     "failed_attachments")
    return (space_summary(spaces, items)
            .join(upload_status(items).drop("total_items"), "space_key", "left")
            .join(att, "space_key", "left"))


def phase_success(requested: DataFrame, done: DataFrame) -> DataFrame:
    """Succeeded and requested keys of a phase, which fails if nothing succeeded."""
    ok = done.select("space_key", F.col("success").alias("_ok"))
    return (requested.join(ok, "space_key", "left")
            .agg(F.count(F.lit(1)).alias("requested"),
                 F.count_if(F.coalesce("_ok", F.lit(False))).alias("succeeded"))
            .withColumn("failed", F.col("succeeded") == 0))


def batch_results(results: DataFrame) -> DataFrame:
    return (results.agg(F.count(F.lit(1)).alias("total_files"),
                        F.count_if(F.col("success")).alias("successful_uploads"),
                        F.count_if(~F.col("success")).alias("failed_uploads"),
                        F.coalesce(F.sum("duration"), F.lit(0.0)).alias("duration"))
            .withColumn("success_rate", percent("successful_uploads", "total_files")))


def first_k_success(results: DataFrame, k: int = 3) -> DataFrame:
    """The first ``k`` successes, and all failures with their reason."""
    w = Window.partitionBy("success").orderBy("seq")
    first = (results.where("success").withColumn("rank", F.row_number().over(w))
             .where(F.col("rank") <= k))
    return first.unionByName(results.where("not success").withColumn("rank", F.lit(None).cast("int")))


def progress_milestones(events: DataFrame) -> DataFrame:
    """Events at which exactly 25, 50 or 75 percent or the end is reached, by ``seq``."""
    total = events.select(F.count(F.lit(1)).cast("long")).scalar()
    counted = number_rows(events, [], ["seq"], "current").withColumn("total", total)
    share = F.col("current") * 100
    hit = (F.col("current") == F.col("total")) | share.isin(
        [F.col("total") * p for p in (25, 50, 75)])
    return counted.where(hit).withColumn("percent", share / F.col("total"))


def progress_report(items: DataFrame, details: DataFrame, elapsed_seconds: float) -> DataFrame:
    """Documents and attachments: done, total, percent, failed, estimated time remaining."""
    docs = items.agg(F.lit("documents").alias("kind"), F.count_if(F.col("created")).alias("done"),
                     F.count(F.lit(1)).alias("total"),
                     F.count_if(~F.col("created") & F.col("failed")).alias("failures"))
    atts = details.agg(F.lit("attachments").alias("kind"), F.count_if(F.col("uploaded")).alias("done"),
                       F.count(F.lit(1)).alias("total"),
                       F.count_if(F.col("upload_failed_at").isNotNull() & ~F.col("uploaded")).alias("failures"))
    left = F.col("total") - F.col("done")
    return (docs.unionByName(atts).withColumn("percent", percent("done", "total"))
            .withColumn("remaining_seconds", F.when(F.col("done") > 0, left * F.lit(float(elapsed_seconds)) / F.col("done"))))


def sorted_files(files: DataFrame, path: str = "path") -> DataFrame:
    return files.orderBy(path)
