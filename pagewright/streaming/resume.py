"""Incremental processing: new and changed pages once across restarts, results versioned by page."""
from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

VERSION = "page_version"


def _changes(key: str, hash_of: str, order: str | None, expire_ms: int | None):
    """The rows of a page whose content differs from the one before, numbered by version."""
    def run(_, batches, state: GroupState):
        if state.hasTimedOut:  # not seen for so long: forgotten, and new when it comes again
            state.remove()
            return
        pdf = pd.concat(list(batches), ignore_index=True)
        pdf = pdf.sort_values([c for c in (order, hash_of) if c], kind="stable", na_position="first")
        last, version = state.get if state.exists else (None, 0)
        kept, versions = [], []
        for at, content in zip(pdf.index, pdf[hash_of]):
            if content != last:
                last, version = content, version + 1
                kept.append(at)
                versions.append(version)
        state.update((last, version))
        if expire_ms:
            state.setTimeoutDuration(expire_ms)
        if kept:
            yield pdf.loc[kept].drop(columns=hash_of).assign(**{VERSION: versions})

    return run


def resume_stream(spark: SparkSession, source: str, schema: T.StructType, checkpoint: str, target: str,
                  step: Callable[[DataFrame], DataFrame], key: str = "page_id", content: str = "html",
                  order: str | None = None, expire_ms: int | None = None, files_per_batch: int = 64) -> StreamingQuery:
    """Run ``step`` over pages that are new or changed since the last run.

    The checkpoint remembers which files were read and, as keyed state spread over the
    executors, the hash of each page's content and its version: a page that arrives again
    unchanged is skipped, a changed one is processed as its next version. ``step`` sees the
    pages with ``page_version`` and keeps key and version in what it returns. Several contents
    of one page in a micro-batch are taken in the order of the column ``order``. A page that is
    not seen for ``expire_ms`` is forgotten, which bounds the state; it comes back as version 1.
    Pages without a key share one state.

    Each micro-batch writes its own folder ``batch=<id>``: one that is repeated after a lost
    executor or driver replaces its own output and nothing else. ``current_pages`` gives the
    latest version of every page.
    """
    def finish(batch: DataFrame, batch_id: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    taken = {f.name for f in schema.fields}
    hash_of = next(n for n in ("_hash", "__hash", "___hash") if n not in taken)
    hashed = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
              .withColumn(hash_of, F.sha2(F.coalesce(F.col(content).cast("string"), F.lit("")), 256)))
    out = T.StructType([*schema.fields, T.StructField(VERSION, T.IntegerType())])
    timeout = GroupStateTimeout.ProcessingTimeTimeout if expire_ms else GroupStateTimeout.NoTimeout
    changed = hashed.groupBy(key).applyInPandasWithState(
        _changes(key, hash_of, order, expire_ms), out, "hash string, version int", "append", timeout)
    return (changed.writeStream.foreachBatch(finish).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_pages(spark: SparkSession, target: str, key: str = "page_id") -> DataFrame:
    """The latest result of every page. Aggregated before it is shuffled, so many versions of one
    page meet in one row; of equal versions (after a page was forgotten) the later batch wins."""
    table = spark.read.parquet(target)
    row = F.struct(*[c for c in table.columns if c != "batch"])
    return table.groupBy(key).agg(F.max_by(row, F.struct("batch", VERSION)).alias("_row")).select("_row.*")
