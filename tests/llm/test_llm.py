"""Every operator against brute force, on small tables with nulls, ties, copies and long texts."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagewright.llm import jaccard, language, mixing, neardup, packing, pii, quality, scoring, sharding, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, n string"
WORDS = "the of and house river stone walk green light water over under with from many".split()


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(7)
    text = lambda n: " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 40)) * (rnd.random() < 0.7) for _ in range(n))
    rows = [(i, text(rnd.randint(1, 90)), "en", f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, rows[3][1], "en", "s0") for i in range(20)]                      # copies
    rows += [(200 + i, rows[5][1] + f" extra{i}", "en", "s1") for i in range(8)]        # near copies
    rows += [(300, None, "en", "s1"), (301, "", None, None), (302, " \n\t ", "en", None), (303, "One", "de", "s2"),
             (304, text(30_000), "en", "s2"), (305, "x" * 50_000, "en", "s2"), (None, "no id here at all", "en", "s3"),
             (306, "mail a.b@c.de or +1 (626) 555-5759, 4785380592391139 at 1.2.3.4", "en", "s3")]
    rows += [rows[8]] * 3                                                               # repeated rows
    return spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def words(text):
    return [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]


def test_mixing_meets_targets_and_caps(docs, empty):
    got = rows_of(mixing.mix(docs))
    by = collections.defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    assert len(got) == docs.count() and mixing.mix(empty).count() == 0
    for part in by.values():
        longest = max(r["size"] for r in part)
        assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= 2 * longest
        assert part[0]["target"] <= 3 * sum(r["size"] for r in part)
    assert sorted(map(str, got)) == sorted(map(str, rows_of(mixing.mix(docs))))
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_sharding_is_level_and_gapless(docs, empty):
    got = rows_of(sharding.assign(docs, shards=4))
    assert len(got) == docs.count() and sharding.assign(empty).count() == 0
    for shard in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_packing_keeps_every_id_once(docs, empty):
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    unique = docs.dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text or "" for r in unique.collect()}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows_of(packing.pack(unique, keep_ids=True)):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc_id, text in texts.items():
        parts = sorted(pieces[doc_id], key=lambda r: r["start"])
        ids = np.array(encoder.encode(text, add_special_tokens=False).ids + [0], dtype="<u4").tobytes()
        assert b"".join(bytes(p["ids"]) for p in parts) == ids
        assert all(zlib.crc32(bytes(p["ids"])) == p["ids_crc32"] for p in parts)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
    assert packing.pack(empty).count() == 0 and set(pieces) == set(texts)


def test_token_counts_equal_the_library(docs, empty):
    encoder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in tokens.with_token_counts(docs).collect():
        assert r.n_tokens == len(encoder.encode(r.text or ""))
    assert tokens.with_token_counts(empty).count() == 0


def brute_components(rows, size, percent):
    sets = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for r, s, x in zip(rows, sets, label):
        if s and r.doc_id is not None:
            least[x] = min(least.get(x, r.doc_id), r.doc_id)
    return sorted(((r.doc_id, len(s), least.get(x) if s else r.doc_id) for r, s, x in zip(rows, sets, label)), key=str)


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_jaccard_components_equal_brute_force(docs, empty, size, percent):
    got = jaccard.join(docs, size=size, percent=percent)
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(docs.collect(), size, percent)
    assert jaccard.join(empty).count() == 0


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64))
        y = np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64))
        bits = sum(bin(int(v) & (2 ** 64 - 1)).count("1") for v in jaccard.parity(x) ^ jaccard.parity(y))
        assert bits <= len(np.setxor1d(x, y))


def test_long_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(2)
    assert jaccard.long_parity(np.arange(jaccard.LARGE, dtype=np.uint64)) is None
    for _ in range(50):
        x = np.unique(rng.integers(0, 9000, rng.integers(1500, 9000)).astype(np.uint64))
        y = np.unique(rng.integers(0, 9000, rng.integers(1500, 9000)).astype(np.uint64))
        assert jaccard.parities_differ(jaccard.long_parity(x), jaccard.long_parity(y)) <= len(np.setxor1d(x, y))
        assert jaccard.parities_differ(jaccard.long_parity(x), jaccard.long_parity(x)) == 0


def test_jaccard_of_large_sets_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        if i % 4 == 0:  # three copies follow, changed more and more; the last ones are on the border
            base = rng.integers(0, 50_000, rng.integers(900, 5000))
        w = base.copy()
        at = rng.random(len(w)) < (0, 0.01, 0.02, 0.045)[i % 4]
        w[at] = rng.integers(0, 50_000, at.sum())
        rows.append((i, " ".join(map(str, w))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, jaccard.join(docs).collect()), key=str) == brute_components(docs.collect(), 4, 85)


def brute_quality(text):
    w, text = words(text), text or ""
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_and_verdicts(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (1, None), (999, 0)], "doc_id long, quality int")
    odd = spark.createDataFrame([(900, "a b c d e f g h i a b c d e f g h i\na b\n\na b|$", "en")], "doc_id long, text string, lang string")
    both = docs.unionByName(odd, allowMissingColumns=True)
    texts = collections.Counter((r.doc_id, *brute_quality(r.text)) for r in both.collect())
    got = quality.judge(both, labels).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == texts
    assert all(not (r.base_failed and r.kept) for r in got) and quality.judge(empty, labels).count() == 0


def test_binomial_tail_is_exact(spark):
    for n, k, p in ((50, 0, 0.1), (400, 7, 0.02), (5000, 3, 0.005)):
        got = spark.range(1).select(quality.log_binomial_cdf(F.lit(n), F.lit(k), p).alias("x")).first().x
        assert math.isclose(math.exp(got), sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)), rel_tol=1e-9)


def test_pii_base_spans_and_redaction(docs, empty):
    found = {r.doc_id: r for r in pii.find(docs).select("doc_id", pii._listed(F.col("base")).alias("b")).collect()}
    assert found[306].b == "email:5:13,ip:56:63,card:36:52,phone:17:34"
    assert found[300].b == "" and found[305].b == "" and pii.find(empty).count() == 0
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[306] == "mail <EMAIL> or <PHONE>, <CARD> at <IP>" and clean[300] is None
    assert clean[303] == "One" and pii.redact(docs).columns == docs.columns


def test_language_keeps_words_and_rejects_none(spark, docs, empty):
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert got[3].lang == "en" and got[3].kept and not got[300].kept and not got[302].kept
    assert language.identify(empty).count() == 0 and language.known_language(docs).columns == docs.columns


def test_scores_have_the_base_of_brute_force(docs, empty):
    rows = docs.collect()
    held = lambda r: zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 1
    counts = collections.Counter(t for r in rows if not held(r) for t in scoring.tokens(r.text))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((str(r.doc_id), len(t := scoring.tokens(r.text)), round(sum(
        math.log10((counts[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in t), 4)) for r in rows)
    got = scoring.score(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got) and scoring.score(empty).count() == 0


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 16))
    near = base[:50].repeat(3, axis=0) + rng.normal(scale=0.05, size=(150, 16))
    data = [(i, [float(np.float32(v)) for v in x]) for i, x in enumerate(np.vstack([base, near, base[:5], base[:5]]))]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0, 2.0]), (1004, [None] * 16), (None, data[0][1])]
    got = neardup.near_duplicates(spark.createDataFrame(data + odd, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)))
    rows = {r.vec_id: r for r in got.collect()}
    x = np.array([v for _, v in data] + [data[0][1]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    degree = (x @ x.T >= 0.95).sum(axis=1) - 1
    assert sum(rows[i].n_links == degree[i] for i, _ in data) >= 0.97 * len(data)
    assert all(rows[i].n_links == 0 and rows[i].component_id == i for i in range(1000, 1005))
    assert rows[550].component_id == 0 and rows[555].component_id == 0
    assert neardup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_mixing_query_equals_its_oracle(spark):
    from tests.compare import connect, difference
    folder = "/root/testdata/sf0.001"
    assert difference(mixing.op1_mixing(spark, folder), connect(folder), mixing.ORACLE) is None


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, folder), name)
        assert docs.columns == columns and docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_hash_of_base_spans(spark):
    one = spark.createDataFrame([(1, "x@y.z")], "doc_id long, text string")
    got = pii.find(one).select(F.sha2(pii._listed(F.col("base")), 256)).first()[0]
    assert got == hashlib.sha256(b"email:0:5").hexdigest()
