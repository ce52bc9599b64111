"""The pipeline's stages, one after another, over odd rows: each against its operator or brute force."""
import collections
import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pagewright.llm import language, mixing
from tests.llm.test_llm import brute_components, rows_of

CLASH = ("key", "_row_key", "_content", "node", "token", "root", "pick", "size", "n")
WORDS = "the of and house river stone walk green light water over under with from many".split()


def odd_documents(spark):
    rnd = random.Random(11)
    text = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    rows = [(i, text(rnd.randint(5, 60)) + f" a.b{i}@c{i}.de", "en", f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, rows[3][1], "en", None) for i in range(4)] + [(None, rows[3][1], "en", "s0")] * 3
    rows += [(200, text(4000), "en", "s1"), (201, None, None, None), (202, "", "en", "s1"), (203, "12 34 56", "en", "s1"),
             (None, text(30), "en", "s2"), (None, text(30), "en", "s2")] + [rows[7]] * 3
    names = ["doc_id long", "text string", "lang string", "source string", "n_chars long", *[f"{c} string" for c in CLASH]]
    return spark.createDataFrame([(*r, 1, *["clash"] * len(CLASH)) for r in rows], ", ".join(names)).repartition(3)


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


def test_stages_over_odd_rows(spark):
    docs = odd_documents(spark).cache()
    stages, columns = dict(corpus_pipeline.STAGES), docs.columns
    step = lambda name, df: corpus_pipeline.stage(stages[name](spark, df, ""), name)

    kept = step("language_id", docs)
    verdicts = {r.doc_id: r.kept for r in language.identify(docs.withColumn("i", F.xxhash64("doc_id", "text")), "i").collect()}
    keyed = docs.withColumn("i", F.xxhash64("doc_id", "text")).collect()
    assert bag(kept.collect()) == bag(r[:-1] for r in keyed if verdicts[r.i]) and kept.columns == columns
    assert 0 < kept.count() < docs.count()

    unique = step("ngram_jaccard", kept)
    rows, left = kept.collect(), unique.collect()
    labels = brute_components(rows, 5, 80)
    assert bag(left) <= bag(rows) and unique.columns == columns
    wanted = len({c for _, n, c in labels if n and c is not None})  # components with an id
    assert len({r.doc_id for r in left if r.doc_id is not None}) == wanted
    assert sum(r.doc_id is None for r in left) == 2  # the copies without an id go, the other two texts stay

    clean = step("pii", unique)
    assert clean.columns == columns and clean.where(F.col("text").contains("@")).count() == 0
    assert clean.where(F.col("text").contains("<EMAIL>")).count() == unique.where(F.col("text").contains("@")).count()

    mixed = step("mixing", clean)
    often = collections.Counter()
    for r in mixing.mix(clean.withColumn("whole", F.struct(*clean.columns))).collect():
        often[tuple(r.whole)] += r.reps
    assert bag(mixed.collect()) == +often and mixed.columns == columns

    pieces = rows_of(stages["packing"](spark, mixed, ""))
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(encoder.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert sum(p["length"] for p in pieces) == tokens
    assert all(p["length"] <= 1024 for p in pieces)


def test_stages_over_an_empty_table(spark):
    docs = odd_documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns, docs = docs.columns, stage(spark, docs, "")
        assert docs.columns == columns and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


def test_run_gives_every_kept_document(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() >= got.select("doc_id").distinct().count() > 100
