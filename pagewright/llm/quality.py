"""Quality rules with risk-controlled thresholds, in DataFrame operations only."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import SPACE, bind, documents, stage, words
from pagewright.operators.numbering import same_keys

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

RISK = 0.02        # false rejections allowed among good documents of a stratum, all rules together
CONFIDENCE = 0.95  # that the risk holds in every stratum and for every rule at once
MIN_PRECISION = 0.5  # share of low quality among the labelled documents that a cutoff rejects

# Rules by name: the measured value, above whose cutoff a document is rejected, and the
# candidate cutoffs from strict to loose.
SHARES = (0.01, 0.03, 0.1, 0.2, 0.4)
RULES = {
    "symbols": (lambda: F.col("n_symbols") / F.greatest("word_chars", F.lit(1)), SHARES),
    "dup_lines": (lambda: F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), SHARES),
    "repeat_words": (lambda: F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)), SHARES),
    "long_words": (lambda: F.col("word_chars") / F.greatest("n_words", F.lit(1)),
                   (7.0, 8.0, 10.0, 16.0)),
    "exclaims": (lambda: F.col("n_exclaims") / F.greatest("n_words", F.lit(1)), SHARES),
}


def repeated_words(found: Column, size: int = WINDOW) -> Column:
    """How many words lie in windows of ``size`` words that occur twice or more among them.

    Windows are compared by a 64-bit hash. Only a text with equal windows is sorted.
    """
    def covered(hashes: Column) -> Column:
        def marked(s: Column) -> Column:
            same = lambda e, j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
            return F.filter(F.transform(s, lambda e, j: F.when(same(e, j + 1) | same(e, j - 1), e["i"])),
                            lambda i: i.isNotNull())

        def width(p: Column) -> Column:
            steps = F.transform(p, lambda at, j: F.least(F.lit(size), F.coalesce(F.get(p, j + 1) - at, F.lit(size))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bind(F.sort_array(bind(placed, marked)), width)

    def windows(h: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)])
        return F.transform(F.sequence(F.lit(0), F.size(h) - size), at)

    several = lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0)
    hashes = F.transform(found, lambda w: F.xxhash64(w))
    return F.when(F.size(found) > size, bind(hashes, lambda h: bind(windows(h), several))).otherwise(0)


def measures(text: str) -> Column:
    """The measured counts of a text as one struct of longs."""
    full = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda line: F.regexp_replace(line, SPACE, "") != "")

    def of_words(w: Column) -> Column:
        chars = F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
        return F.struct(F.size(w).cast("long").alias("n_words"), chars.alias("word_chars"),
                        repeated_words(w).cast("long").alias("n_repeat_words"))

    def of_lines(found: Column) -> Column:
        return F.struct(F.size(found).cast("long").alias("n_lines"),
                        (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"))

    return F.struct(bind(words(text), of_words).alias("w"), bind(lines, of_lines).alias("l"),
                    F.regexp_count(full, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                    F.regexp_count(full, F.lit("!")).cast("long").alias("n_exclaims"))


def log_binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """log P(X <= k) for X ~ Binomial(n, p), summed exactly term by term in log space."""
    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + math.log(p / (1 - p))
        top = F.greatest(acc["total"], term)
        return F.struct(term.alias("term"),
                        (top + F.log(F.exp(acc["total"] - top) + F.exp(term - top))).alias("total"))

    first = (n * F.lit(math.log1p(-p))).cast("double")
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, F.struct(first.alias("term"), first.alias("total")), step)["total"]


def cutoffs(measured: DataFrame, stratum: str, good: str, risk: float = RISK,
            confidence: float = CONFIDENCE) -> DataFrame:
    """One row per stratum with a cutoff for each rule, null where none is safe.

    ``measured`` holds the labelled holdout. For every stratum, rule and candidate cutoff, the
    number of good documents that the cutoff would reject is tested against the rate
    ``risk`` / rules by its exact binomial tail (the Clopper-Pearson bound). The error
    probability is shared by all tests (Bonferroni), so with ``confidence`` no stratum loses
    more than ``risk`` of its good documents. Of the cutoffs that pass, and of whose rejected
    labelled documents at least half are of low quality, the strictest is taken.
    """
    value = {name: of().cast("double") for name, (of, _) in RULES.items()}
    tests = [(name, c) for name, (_, candidates) in RULES.items() for c in candidates]
    counts = [f(F.col(good) == label, value[name] > c).alias(f"{what}_{i}")
              for i, (name, c) in enumerate(tests)
              for what, label, f in (("k", 1, lambda a, b: F.count_if(a & b)), ("bad", 0, lambda a, b: F.count_if(a & b)))]
    table = stage(measured.groupBy(stratum).agg(F.count_if(F.col(good) == 1).alias("n"), *counts), "holdout")
    level = math.log((1 - confidence) / max(1, table.count() * len(tests)))
    rate = risk / len(RULES)

    def passes(i: int) -> Column:
        k, bad = F.col(f"k_{i}"), F.col(f"bad_{i}")
        return ((k < F.col("n") * rate) & (bad >= MIN_PRECISION * (k + bad)) & (bad > 0)
                & (log_binomial_cdf(F.col("n"), k, rate) <= level))

    chosen = [F.coalesce(*[F.when(passes(i), F.lit(float(c))) for i, (other, c) in enumerate(tests) if other == name])
              .alias(f"cut_{name}") for name in RULES]
    return stage(table.select(stratum, *chosen), "cutoffs")


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          stratum: str = "lang", good: str = "quality") -> DataFrame:
    """One row per document: doc_id, the measured counts, base_failed and kept.

    A document fails the base rules with under 20 words, or with over 30 percent of its words
    in repeated windows of eight. Else it is kept unless a rule's cutoff for its stratum is
    exceeded (see ``cutoffs``). Labels with no document, of no id or without a label are
    ignored; repeated labels count once, the lowest one, and so do repeated rows of a labelled
    id (one trial each, the row of least stratum and counts). A null stratum is a stratum; one
    without enough labels has no cutoffs. A null text has no words and fails. Repeated rows
    are judged alike; an empty table gives no rows. Other columns are not read.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), measures(text).alias("m"))
    found = stage(slim.select("doc_id", "stratum", "m.w.*", "m.l.*", "m.n_symbols", "m.n_exclaims"), "measures")
    truth = (labels.where(F.col(good).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(good).alias("good")))
    trial = F.struct(*[c for c in found.columns if c != "doc_id"])
    trials = found.join(truth, "doc_id").groupBy("doc_id", "good").agg(F.min(trial).alias("m")).select("good", "m.*")
    cuts = cutoffs(trials, "stratum", "good")
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    above = [F.coalesce(of().cast("double") > F.col(f"cut_{name}"), F.lit(False)) for name, (of, _) in RULES.items()]
    rejected = above[0]
    for one in above[1:]:
        rejected = rejected | one
    return (same_keys(found, cuts, ["stratum"], "left")
            .withColumn("base_failed", failed).withColumn("kept", ~failed & ~rejected))


def op9_quality(spark, sf_dir):
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
