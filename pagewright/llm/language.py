"""Language identification by Bayesian fusion of text, markup, address and host evidence."""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import content_hash, documents, fresh_name, small_batches, stage, without
from pagewright.operators.numbering import same_keys

LANGUAGES = ("de", "en", "es", "fr")
BUCKETS = 1 << 14   # hashed byte trigrams; the model has a row for each, which bounds it
EFFECTIVE = 200     # a text counts as so many independent trigrams at most
PRIOR_ROWS = 20.0   # weight of the parent's prior in a host's
UNKNOWN = 0.01      # prior of a text in no known language, under which all trigrams are equal
LEAST = 0.5         # posterior below which a document is rejected


# Bytes of letters and the blank between words; digits and signs say nothing of a language.
LETTERS = np.array([b == 32 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def grams(text: str) -> np.ndarray:
    """Hashed trigrams of bytes of the lower-cased text that hold letters and blanks only."""
    raw = np.frombuffer(text.lower().replace("\n", " ").encode(), np.uint8)
    if len(raw) < 3:
        return np.empty(0, np.int64)
    fine = LETTERS[raw]
    fine = fine[:-2] & fine[1:-1] & fine[2:]
    raw = raw.astype(np.uint32)
    code = ((raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:])[fine]
    return (code * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64)


def _count(languages: tuple[str, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            for declared, text in zip(batch["declared"], batch["text"]):
                if text and declared in languages:
                    counts[languages.index(declared)] += np.bincount(grams(text), minlength=BUCKETS)
        lang, bucket = np.nonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": bucket, "n": counts[lang, bucket]})

    return run


def _score(log_p: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores, sizes = [], []
            for text in batch["text"]:
                found = grams(text or "")
                total = log_p @ np.bincount(found, minlength=BUCKETS) if len(found) else np.zeros(len(log_p))
                sizes.append(len(found))
                scores.append((total * min(1.0, EFFECTIVE / max(len(found), 1))).tolist())
            yield batch.drop(columns="text").assign(n_grams=sizes, text_score=scores)

    return run


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text", declared: str | Column = "lang",
             host: str | Column = "source", parent: str | Column | None = None,
             suffix: str | Column | None = None, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """One row per document: doc_id, lang (most probable), posterior, text_lang (by text
    alone) and kept.

    Text: naive Bayes over hashed byte trigrams, trained on what documents declare, over the
    whole table; long texts count as a bounded number of trigrams, so that other evidence is
    heard. The declared language and the address suffix add P(value | language), counted
    against the language by text. A host's prior is its documents' languages (without the
    document at hand), smoothed by its parent's, which is smoothed by the corpus'. One more
    class stands for no known language. A document is kept if a language is the most probable
    class and reaches ``LEAST``.

    Null or empty evidence says nothing; a text under three bytes has no text evidence, and a
    document with neither text nor a letter in it is rejected. Null hosts share one prior.
    Equal rows are judged alike, other columns are not read, an empty table gives no rows.
    Counts are grouped aggregates; hosts are joined, never collected.
    """
    small_batches(docs.sparkSession)
    col = lambda c: F.lit(None).cast("string") if c is None else (F.col(c) if isinstance(c, str) else c).cast("string")
    rows = docs.select(F.col(doc_id).alias("doc_id"), col(text).alias("text"),
                       F.lower(F.left(col(declared), F.lit(2))).alias("declared"), col(host).alias("host"),
                       col(parent).alias("parent"), F.lower(col(suffix)).alias("suffix"))
    rows = rows.withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    counted = rows.select("declared", "text").where(F.col("declared").isin(*languages)).mapInPandas(
        _count(languages), "lang int, bucket int, n long")
    # at most languages * BUCKETS rows
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), BUCKETS))
    counts[table["lang"].to_numpy(int), table["bucket"].to_numpy(int)] = table["n"].to_numpy()
    log_p = np.log(counts + 0.5) - np.log(counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)

    names = "doc_id, declared, host, parent, suffix, letters"
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names.split(", ")) + ", n_grams long, text_score array<double>"
    scored = rows.select(*names.split(", "), "text").mapInPandas(_score(log_p), schema)
    best = F.array_position("text_score", F.array_max("text_score")) - 1
    scored = stage(scored.withColumn("guess", F.when(F.col("n_grams") > 0, best).cast("int")), "scored")

    indices = range(len(languages))
    sure = scored.where("guess IS NOT NULL")

    def tally(key: str, prefix: str) -> DataFrame:
        return sure.groupBy(key).agg(*[F.count_if(F.col("guess") == i).cast("double").alias(f"{prefix}{i}") for i in indices])

    overall = sure.agg(*[F.count_if(F.col("guess") == i).alias(f"n{i}") for i in indices]).first()
    total = sum(overall)
    base = [(n + 1) / (total + len(languages)) for n in overall]
    joined = scored
    for key, prefix in (("host", "h"), ("parent", "p"), ("declared", "d"), ("suffix", "s")):
        joined = same_keys(joined, stage(tally(key, prefix), f"by-{key}"), [key], "left")
    count = lambda prefix, i: F.coalesce(F.col(f"{prefix}{i}"), F.lit(0.0))
    own = lambda i: F.coalesce((F.col("guess") == i).cast("double"), F.lit(0.0))
    less = F.col("guess").isNotNull().cast("double")

    def prior(prefix: str, i: int, above: Column) -> Column:
        rest = sum((count(prefix, j) for j in indices), F.lit(0.0)) - less
        return (count(prefix, i) - own(i) + PRIOR_ROWS * above) / (F.greatest(rest, F.lit(0.0)) + PRIOR_ROWS)

    def given(prefix: str, key: str, i: int) -> Column:
        likelihood = F.log((count(prefix, i) - own(i) + 1.0) / float(overall[i] + 10))
        return F.when(F.col(key).isNotNull() & (F.col(key) != ""), likelihood).otherwise(0.0)

    evidence = [F.log(prior("h", i, prior("p", i, F.lit(base[i])))) + F.get("text_score", F.lit(i))
                + given("d", "declared", i) + given("s", "suffix", i) for i in indices]
    unknown = (math.log(UNKNOWN) - F.least("n_grams", F.lit(EFFECTIVE)) * math.log(BUCKETS)
               + F.when(F.col("declared").isNotNull() & (F.col("declared") != ""), math.log(0.1)).otherwise(0.0)
               + F.when(F.col("suffix").isNotNull() & (F.col("suffix") != ""), math.log(0.1)).otherwise(0.0))
    fused = joined.withColumn("e", F.array(*evidence, unknown))
    fused = fused.withColumn("top", F.array_max("e"))
    mass = F.aggregate("e", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    known = F.slice("e", 1, len(languages))
    at = F.array_position(known, F.array_max(known)) - 1
    lang = F.get(F.array(*map(F.lit, languages)), at.cast("int"))
    posterior = F.exp(F.array_max(known) - F.col("top")) / mass
    return fused.select(
        "doc_id", lang.alias("lang"), posterior.alias("posterior"),
        F.get(F.array(*map(F.lit, languages)), F.col("guess")).alias("text_lang"),
        (F.col("letters") & (posterior >= LEAST)).alias("kept"))


def known_language(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept; the columns stay as they are. The verdict belongs to the
    content of a row, by 128 bits of its hash: rows of no id, or of one id, do not share it."""
    key = F.concat_ws("-", content_hash(docs), content_hash(docs, 1))
    name = fresh_name(docs, "_content")
    gone = stage(identify(docs.withColumn(name, key), name, **options).where(~F.col("kept")).select("doc_id").distinct(), "rejected")
    return without(docs, gone, key)


def op2_language_id(spark, sf_dir):
    return identify(documents(spark, sf_dir))


def language_id_pages(spark, sf_dir):
    """Raw pages, with all kinds of evidence: markup, address suffix, host and its parent."""
    html = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " ")
    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.col("page_id").alias("doc_id"), F.regexp_replace(html, "<[^>]*+>", " ").alias("text"),
        F.regexp_extract("html", r"(?i)<html[^>]*?\blang=[\"']?([a-zA-Z]{2})", 1).alias("declared"),
        host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("parent"),
        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"))
    return identify(pages, "doc_id", "text", "declared", "host", "parent", "suffix").withColumnRenamed("doc_id", "page_id")
