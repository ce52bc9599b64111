"""Resampling, vector codes and decontamination against brute force, on odd tables."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import alnum, codes, decontaminate, resample

SCHEMA = "doc_id long, text string, row string, line string, n string, span string, fp string, label string"
RULE = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute_words(text):
    return RULE.findall((text or "").translate(UPPER))


@pytest.fixture(scope="module")
def items(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 30)) for _ in range(rnd.randint(10, 40)))) for i in range(20)]
    rows += [(20, "Short one"), (21, "solo"), (22, None), (23, ""), (24, " .. "), (None, "not listed at all"), (25, rows[0][1]),
             (26, rows[1][1].upper().replace(" ", ", ")), (1, "of the same id"), (27, "é" * 3 + " 三 x y z 1 2 3 4 5 6")]
    return spark.createDataFrame([(*r, "clash") for r in rows], "item_id long, text string, size string")


@pytest.fixture(scope="module")
def docs(spark, items):
    rnd = random.Random(4)
    passages = [r.text for r in items.collect() if r.text]
    word = lambda: rnd.choice("abcdefghijk") + str(rnd.randint(0, 30))
    rows = []
    for i in range(120):
        parts = [word() + rnd.choice(" \n,  \n\n;.") for _ in range(rnd.randint(0, 120))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages).split(" ")
            a = rnd.randint(0, max(0, len(p) - 9))
            parts.insert(rnd.randint(0, len(parts)), " ".join(p[a:a + rnd.randint(8, 14)]) + " ")
        rows.append((i, "".join(parts)))
    line = "The same line in many texts."
    rows += [(200 + i, f"{line}\n{'x' * (i % 3)}\n{line}\nEnd {i}") for i in range(60)]
    rows += [(300, None), (301, ""), (302, "\n\n"), (303, "one"), (304, "a\nb\nc d\n\ne"), (305, "W" * 40_000),
             (306, " ".join(word() for _ in range(30_000))), (None, passages[0]), (None, "no id"), (307, "\x00 nul\x0bA\x7fB\r\nü ß")]
    rows += [rows[5]] * 3 + [(308, passages[2] + "\n" + passages[3])]
    return spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], SCHEMA).repartition(5)


def test_words_follow_the_pattern(docs):
    for r in docs.collect():
        assert [w.decode() for w in alnum.words(r.text)] == brute_words(r.text)


def features(text):
    w = brute_words(text)
    return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_resample(rows, target, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = collections.Counter(bucket(f) for r in rows for f in features(r.text))
    t = collections.Counter(bucket(f) for x in target for f in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10_000) / ((s[b] + 1.0) * (all_t + 10_000))))
    out = []
    for r in rows:
        found = features(r.text)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"42:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        out.append([r.doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(brute_words(r.text)) >= least])
    fit = sorted((o for o in out if o[4]), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    n = percent * len(fit) // 100
    return sorted([(*o[:4], i + 1 if i < n else None) for i, o in enumerate(fit)] + [(*o[:4], None) for o in out if not o[4]], key=str)


@pytest.mark.parametrize("percent,least", [(5, 20), (50, 3), (100, 1)])
def test_resampling_equals_brute_force(docs, items, percent, least):
    got = resample.resample(docs, items, percent=percent, least_words=least)
    want = brute_resample(docs.collect(), [r.text for r in items.collect()], percent, least)
    # rows of one score and one id, or of none, are ranked in any order
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_resampling_of_empty_tables(docs, items):
    assert resample.resample(docs.limit(0), items).count() == 0
    got = resample.resample(docs, items.limit(0)).collect()
    assert len(got) == docs.count() and all(r.weight is not None for r in got)


def test_lines_are_counted_once_and_met_by_frequency(docs, monkeypatch):
    parts, lines = resample.segments(docs, "doc_id", "text")
    rows = lines.collect()
    assert len({bytes(r.line) for r in rows}) == len(rows)
    assert max(r.n for r in rows) == 120  # twice in each of 60 texts
    want = collections.Counter(zlib.crc32(f.encode()) % 10_000 for r in docs.collect() for f in features(r.text))
    got = resample.bucket_counts(parts, lines)
    assert {i: int(n) for i, n in enumerate(got) if n} == want
    by = {hot: sorted(map(tuple, resample.weigh(docs, docs).drop("row").collect()), key=str)
          for hot in (1, 10, 10 ** 9) if not monkeypatch.setattr(resample, "HOT_LINES", hot)}
    assert by[1] == by[10] == by[10 ** 9]


def test_packed_buckets_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 4000):
        found = rng.integers(0, 10_000, n)
        assert (resample.unpack(resample.pack(found)) == np.sort(found)).all()


def brute_hits(rows, items):
    windows = collections.defaultdict(set)
    for r in items:
        w = brute_words(r.text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(r.item_id)
    out = []
    for r in rows:
        w = brute_words(r.text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        listed = sorted(str(x) for x in found if x is not None)
        out.append((r.doc_id, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [decontaminate.SMALL, 0])
def test_decontamination_equals_brute_force(docs, items, small, monkeypatch):
    monkeypatch.setattr(decontaminate, "SMALL", small)
    got = decontaminate.decontaminate(docs, items)
    want = brute_hits(docs.collect(), items.collect())
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert 20 < sum(r[-1] for r in want) < len(want)


def test_decontamination_of_empty_tables(docs, items):
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).where("contaminated OR n_items > 0").count() == 0


def test_every_window_keeps_its_smallest_run():
    rng = np.random.default_rng(2)
    grams = rng.integers(0, 50, 300).astype(np.uint64)
    low, at = decontaminate.smallest(grams)
    for i in range(len(low)):
        part = grams[i:i + decontaminate.SLIDE]
        assert low[i] == part.min() and at[i] == i + len(part) - 1 - part[::-1].argmin()
    assert len(decontaminate.smallest(grams[:3])[0]) == 0


def brute_codes(rows, parts, entries, rounds):
    fine = [r for r in rows if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)]
    fine.sort(key=lambda r: (r.vec_id is None, r.vec_id or 0, r.embedding))
    x = [[math.floor(256 * v) for v in r.embedding] for r in fine]
    w = len(x[0]) // parts
    cut = [[v[k * w:k * w + w] for k in range(parts)] for v in x]
    books = [[list(v[k]) for v in cut[:entries]] for k in range(parts)]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    assign = lambda: [[min((far(v[k], e), j) for j, e in enumerate(books[k])) for k in range(parts)] for v in cut]
    for _ in range(rounds):
        at = assign()
        for k in range(parts):
            for j in range(len(books[k])):
                own = [v[k] for v, a in zip(cut, at) if a[k][1] == j]
                if own:
                    books[k][j] = [sum(c) // len(own) for c in zip(*own)]
    at = assign()
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    by = collections.Counter()
    for r, a in zip(fine, at):
        by[r.label] += sum(d for d, _ in a)
    return sorted(((r.vec_id, "".join(f"{j:02x}" for _, j in a), sum(d for d, _ in a), by[r.label], sha) for r, a in zip(fine, at)), key=str)


@pytest.mark.parametrize("n,kind", [(150, "array<float>"), (20, "array<double>")])
def test_codes_equal_brute_force(spark, n, kind):
    rng = np.random.default_rng(n)
    data = [(i, [float(v) for v in np.float32(rng.normal(size=32) * 0.2)], int(i % 3)) for i in range(n)]
    data += [data[2], (1, data[3][1], None), (None, data[4][1], None), (500, None, 1), (501, [None] * 32, 1), (502, [float("nan")] * 32, 1),
             (503, [float("inf")] + [0.0] * 31, 1), (504, [0.0] * 32, 1), (505, [], 1), (506, [1000.0] * 32, 9)]
    table = spark.createDataFrame(data, f"vec_id long, embedding {kind}, label int").withColumn("code", F.lit("clash")).repartition(3)
    rows = [r for r in table.collect() if r.embedding != []]
    got = codes.compress(table, parts=8, entries=40)
    assert sorted(map(tuple, got.collect()), key=str) == brute_codes(rows, 8, 40, 2)


def test_codes_of_empty_tables(spark):
    none = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert codes.compress(none).count() == 0 and codes.compress(none.limit(0)).count() == 0


def test_pivots_prune_and_keep_the_nearest():
    rng = np.random.default_rng(6)
    x, entries = rng.integers(-90, 90, (3000, 4)), rng.integers(-90, 90, (64, 4))
    entries[40] = entries[7]  # a tie
    pivots = codes.choose_pivots(entries)
    at, apart, evaluated = codes.nearest(x, codes.distances(x, pivots), entries, pivots)
    all_apart = ((x[:, None] - entries) ** 2).sum(axis=2)
    assert (at == all_apart.argmin(axis=1)).all() and (apart == all_apart.min(axis=1)).all() and 40 not in at
    assert evaluated < 0.25 * all_apart.size
    big = x.astype(np.int64) * (codes.BOUND // 100)
    assert (codes.nearest(big, codes.distances(big, big[:4]), big[:64], big[:4])[1] >= 0).all()


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_vector_codes", "op13_decontamination"])
def test_queries_equal_their_oracles(spark, name):
    from pagewright.llm import registry
    from tests.compare import connect, difference
    folder = "/root/testdata/sf0.001"
    assert difference(registry.QUERIES[name](spark, folder), connect(folder), registry.ORACLES[name]) is None
