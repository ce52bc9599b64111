"""Mixing where all words times a weight exceed an int, as some 2 GB of documents do."""
import collections

import corpus_pipeline
from pagewright.llm import mixing
from pagewright.llm.common import word_count

MANY = 5_000_000  # each word counts for so many: 1.2e9 in all, an int until it is weighted


def documents(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(1 + i % 7)), "abc"[i % 3]) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def test_targets_of_large_sources(spark):
    sources = spark.createDataFrame([("a", 600_000_000, 5), ("b", 900_000_000, 2)], "s string, source_size long, weight int")
    got = {r.s: r.target for r in mixing.water_fill(sources, 1_500_000_000, 3).collect()}
    assert got == {"a": 1_500_000_000 * 5 / 7, "b": 1_500_000_000 * 2 / 7}


def test_the_pipeline_mixes_large_sources_like_small_ones(spark, monkeypatch):
    docs = documents(spark)
    small = collections.Counter(map(str, corpus_pipeline.mix(spark, docs, "").collect()))
    target = {r.source: r.target for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "word_count", lambda text: word_count(text) * MANY)
    assert collections.Counter(map(str, corpus_pipeline.mix(spark, docs, "").collect())) == small
    large = {r.source: r.target for r in mixing.mix(docs).collect()}
    assert all(abs(large[s] / MANY - target[s]) < 1e-6 for s in target) and sum(target.values()) * MANY < 1 << 63
