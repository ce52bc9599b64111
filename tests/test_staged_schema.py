"""A staged table is written by one job; its schema is not read from the files by another."""
from pyspark.sql import functions as F

from pagewright.llm import mixing
from pagewright.session import stage


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_one_job_writes_a_table(spark):
    df = spark.range(10).select("id", F.lit(None).cast("string").alias("none"), F.array("id").alias("ids"))
    table, jobs = jobs_of(spark, "staged", lambda: stage(df, "staged"))
    assert jobs == 1
    assert table.dtypes == df.dtypes and sorted(map(tuple, table.collect())) == sorted(map(tuple, df.collect()))
    empty = stage(df.limit(0), "staged")
    assert empty.dtypes == df.dtypes and empty.count() == 0


def test_sums_of_buckets_and_levels_are_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(mixing, "stage", lambda df, name, real=mixing.stage: written.append(name) or real(df, name))
    rows = [(i, "a b c " * (i % 7), ["x", "y", None][i % 3]) for i in range(60)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert written == ["mix", "mix-buckets", "mix-sources", "mix-levels", "mix-plan"]
    assert mixed.count() == 60
