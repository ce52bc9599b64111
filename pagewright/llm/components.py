"""Connected components of a link table, by alternating stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import stage, unstage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being the smallest node it reaches.

    Each round ties the larger neighbours of a node to its smallest one, then the smaller
    ones; every round is a table in the shared folder and ends in one sum that tells whether
    anything moved. Rounds grow with the logarithm of the longest chain.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.greatest("b", "m").alias("x"), F.least("b", "m").alias("y"))
        last = edges
        edges = stage(small.select(F.col("x").alias("a"), F.col("y").alias("b")).where("a <> b")
                      .unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        unstage(last)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
