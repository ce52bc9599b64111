"""Mixing sources to target weights: capped water-filling, then seeded repetitions."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import documents, stage, word_count
from pagewright.operators.numbering import number_rows, same_keys

CYCLE = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
BUCKET_DIGITS = 3  # hexadecimal digits of the draw: 4096 buckets a source


def draw(doc_id: str, text: str, seed: str):
    """A seeded place of the document in the order in which its source is drawn; only rows
    equal in id and text share one."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}|"), part(doc_id), F.lit("|"), F.md5(part(text))))


def water_fill(sources: DataFrame, budget: int, max_epochs: int) -> DataFrame:
    """Targets of a table (source_size, weight): shares of ``budget`` by weight, no target
    above ``max_epochs`` times the source's size.

    Each round clamps the sources above their cap and shares what they leave among the
    others by weight, until none is above. Only four sums reach the driver per round.
    """
    cap = F.col("source_size").cast("decimal(38,0)") * max_epochs
    free, weight, clamped = budget, None, -1
    over = F.lit(False)
    while True:
        row = sources.agg(
            F.count_if(over).alias("n"), F.sum(F.when(over, cap)).alias("taken"),
            F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        free, weight = budget - int(row["taken"] or 0), int(row["weight"] or 0)
        if row["n"] == clamped or not weight:
            break
        clamped = row["n"]
        over = cap * weight < F.lit(free).cast("decimal(38,0)") * F.col("weight")
    # words of a large table times a weight exceed an int, which a literal below 2^31 would be
    share = F.lit(free).cast("long") * F.col("weight") / F.lit(max(weight, 1))
    return sources.withColumn(
        "target", F.when(over, F.col("source_size") * F.lit(max_epochs)).otherwise(share).cast("double"))


def plan(docs: DataFrame, doc_id: str, text: str, source: str, cycle: tuple[int, ...],
         share: float, max_epochs: int, seed: str) -> DataFrame:
    """One row per source: source_size, target, whole repetitions, the draw up to which its
    documents are taken once more (``cut``), and the draw of equal rows of which only ``copies``
    are (``edge``, null where the rest ends between different rows)."""
    slim = stage(docs.select(F.col(source).alias("s"), draw(doc_id, text, seed).alias("h"),
                             word_count(text).alias("size")), "mix")
    slim = slim.withColumn("b", F.substring("h", 1, BUCKET_DIGITS))
    # written once: sizes, levels, edges and whole buckets read it, and their plans stay small
    buckets = stage(slim.groupBy("s", "b").agg(F.sum("size").alias("n")), "mix-buckets")
    sizes = buckets.groupBy("s").agg(F.sum("n").alias("source_size"))
    ranked = number_rows(sizes, [], [F.col("s").asc_nulls_last()], "rank")
    place = F.pmod(F.col("rank") - 1, F.lit(len(cycle))).cast("int")
    sources = stage(ranked.withColumn("weight", F.get(F.array(*map(F.lit, cycle)), place)), "mix-sources")

    total = sources.agg(F.sum("source_size")).first()[0] or 0
    filled = water_fill(sources, int(total * share) if share != 1 else total, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    filled = (filled.withColumn("whole", whole.cast("long"))
              .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))

    # the bucket of the draw in which the rest runs out, then the place inside it
    until = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    level = stage(same_keys(buckets.withColumn("upto", F.sum("n").over(until)),
                            filled.select("s", "rest"), ["s"]), "mix-levels")
    edge = (level.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest")))
            .withColumn("before", F.col("upto") - F.col("n")).select("s", "b", "before", "rest"))
    inside = (same_keys(slim, edge, ["s", "b"]).groupBy("s", "h", "before", "rest")
              .agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("k")))
    running = Window.partitionBy("s").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    # of k equal rows, copy j (from 0) is taken if half of it still fits
    fits = F.ceil((F.col("rest") - F.col("start")) * F.col("k") / F.greatest("n", F.lit(1)) - 0.5)
    copies = F.when(F.col("n") > 0, fits).when(F.col("start") < F.col("rest"), F.col("k")).otherwise(0)
    taken = (inside.withColumn("start", F.col("before") + F.sum("n").over(running) - F.col("n"))
             .withColumn("copies", F.least("k", copies)).where("copies > 0"))
    full = level.where(F.col("upto") <= F.col("rest")).select(
        "s", F.concat("b", F.lit("z")).alias("h"), F.lit(1).alias("k"), F.lit(1).alias("copies"))
    whole_rows, part = F.col("copies") == F.col("k"), F.col("copies") < F.col("k")
    cut = taken.select("s", "h", "k", "copies").unionByName(full).groupBy("s").agg(
        F.max(F.when(whole_rows, F.col("h"))).alias("cut"), F.max(F.when(part, F.col("h"))).alias("edge"),
        F.max(F.when(part, F.col("copies"))).alias("copies"))
    # as a table its size is known, so a small one is broadcast and documents stay in place
    return stage(same_keys(filled, cut, ["s"], "left").select(
        "s", "source_size", "target", "whole", F.coalesce("cut", F.lit("")).alias("cut"), "edge", "copies"), "mix-plan")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        cycle: tuple[int, ...] = CYCLE, share: float = 1.0, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """Add ``size`` (words), ``source_size``, ``target``, ``reps`` and ``taken`` to documents.

    Sources in code point order, null last, weigh ``cycle`` in turn and share ``share`` of all
    words; none gets more than ``max_epochs`` times its own. A source at e epochs takes each
    document floor(e) times, and once more the documents first in a seeded order until the
    rest is reached; the document on the edge is taken if at least half of it still fits, so a
    source misses its target by half a document at most. The same data gives the same mix.

    A null text has size 0; null is a source. Rows without an id, or of one id, are drawn by
    their text as well; of rows equal in both, as many are taken as fit. Added columns replace
    input columns of the same name. Empty in, empty out.
    Only one row per source, and 4,096 sums per source, are gathered; the order inside a
    source is needed in one bucket of 4,096 alone.
    """
    sources = plan(docs, doc_id, text, source, cycle, share, max_epochs, seed)
    sized = docs.withColumns({"size": word_count(text), "_mix_key": F.col(source), "_mix_draw": draw(doc_id, text, seed)})
    sized = sized.drop("source_size", "target")
    joined = same_keys(sized, sources.withColumnsRenamed(
        {"s": "_mix_key", "whole": "_mix_whole", "cut": "_mix_cut", "edge": "_mix_edge", "copies": "_mix_copies"}),
        ["_mix_key"])
    reps = F.col("_mix_whole") + (F.col("_mix_draw") <= F.col("_mix_cut")).cast("long")
    mixed = joined.withColumn("reps", reps)
    if not sources.where(F.col("edge").isNotNull()).isEmpty():
        at_edge = F.coalesce(F.col("_mix_draw") == F.col("_mix_edge"), F.lit(False))
        equal = number_rows(mixed.where(at_edge), ["_mix_key"], [F.monotonically_increasing_id()], "_mix_rn")
        once = (F.col("_mix_rn") <= F.col("_mix_copies")).cast("long")
        mixed = mixed.where(~at_edge).unionByName(
            equal.withColumn("reps", F.col("_mix_whole") + once).drop("_mix_rn"))
    return (mixed.withColumn("taken", F.col("reps") * F.col("size"))
            .drop("_mix_key", "_mix_draw", "_mix_whole", "_mix_cut", "_mix_edge", "_mix_copies"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns it came with."""
    taken = mix(docs.withColumn("_mix_row", F.struct(*docs.columns)), **options)
    return (taken.where("reps > 0").select("_mix_row", F.explode(F.array_repeat(F.lit(1), F.col("reps").cast("int"))))
            .select("_mix_row.*"))


def op1_mixing(spark, sf_dir):
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS h,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
    (sum(source_size) OVER ())::BIGINT AS total FROM s),
-- in order of size per weight, the clamped sources come first
o AS (SELECT *, total - coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS free,
    (sum(w) OVER rest)::BIGINT AS weight FROM w
  WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
c AS (SELECT *, 3 * source_size * weight < free * w AS clamped FROM o),
f AS (SELECT coalesce(sum(w) FILTER (NOT clamped), 1)::BIGINT AS weight,
    (any_value(total) - coalesce(sum(3 * source_size) FILTER (clamped), 0))::BIGINT AS free FROM c),
t AS (SELECT source, source_size, CASE WHEN clamped THEN (3 * source_size)::DOUBLE
    ELSE f.free * w / f.weight END AS target FROM c, f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
r AS (SELECT d.*, e.source_size, target, whole, target - whole * e.source_size AS rest,
    (sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  (whole + CASE WHEN 2 * start + size < 2 * rest THEN 1 ELSE 0 END) * size AS taken FROM r
"""
