"""Session helpers: recommended settings and the shared scratch folder."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are designed for. Hot pages, users or spaces are split by
# AQE when a join key is skewed, also when a later step would like to reuse the partitioning.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # tasks follow the data: many small shuffle partitions, joined by AQE up to a size whose rows
    # a task can sort in memory, so that larger inputs get more tasks instead of spilling ones
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # pages and archives may be large: hand Python few rows at a time
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.session.timeZone": "UTC",
    # keyed streaming state on disk instead of in executor memory
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# For page jobs: while the tokens of a page are sorted, they take some hundred times the room of
# its shuffled source (measured: 117 KB for 0.4 KB), so that 16 MB of pages would be spilled.
PAGE_JOBS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    # the JVM compiles no method of more bytecode than this: a larger one would be interpreted for each token
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # tokens arrive sorted by page: pages are aggregated as they come, not hashed and sorted once more
    "spark.sql.execution.useObjectHashAggregateExec": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended runtime settings to a session; those of page jobs end."""
    for key in PAGE_JOBS.keys() - RECOMMENDED.keys():
        spark.conf.unset(key)
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def small_partitions(spark: SparkSession) -> None:
    """Apply ``PAGE_JOBS`` until the next ``configure``: tasks of pages whose tokens fit into memory."""
    for key, value in PAGE_JOBS.items():
        spark.conf.set(key, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode with the setting absent (tests).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="pagewright-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table once to the shared folder and read it back; ``options`` are those of the writer.

    For results that several later passes read: it cuts the lineage, survives lost executors
    and keeps column pruning, unlike a checkpoint of rows. This runs a job when called; its
    schema is known, so no second job reads it from the files.
    """
    folder = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    table = df.sparkSession.read.schema(df.schema).parquet(folder)
    table._folder = folder
    return table


def stage_small(df: DataFrame, name: str) -> DataFrame:
    """``stage`` with less disk for more CPU: packed tighter, and the shuffles that made it go at once."""
    table = stage(df, name, compression="zstd")
    release_shuffles(df.sparkSession)
    return table


def release_shuffles(spark: SparkSession) -> None:
    """Let the files of shuffles that no plan holds any more be deleted now: Spark does so once the
    driver has collected the plans that made them, which by itself may come after the query."""
    spark.sparkContext._jvm.System.gc()


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that no result reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
