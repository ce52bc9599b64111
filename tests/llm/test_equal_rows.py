"""Rows of one id or none, and repeated rows, in mixing, sharding and quality rules."""
import collections

from pagewright.llm import mixing, quality, sharding


def test_sources_without_ids_reach_their_targets(spark):
    rows = [(None, " ".join(f"w{i}x{k}" for k in range(10)), "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = collections.defaultdict(int)
    target = {}
    for r in mixing.mix(docs).collect():
        got[r.source] += r.taken
        target[r.source] = r.target
    assert set(target) == {"a", "b"} and all(abs(got[s] - target[s]) <= 5 for s in target)


def test_equal_rows_are_taken_one_by_one(spark):
    rows = [(7, "one two three four", "a")] * 300 + [(None, "five six", "b")] * 300 + [(i, "seven " * 5, "c") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix(docs).collect()
    taken, target, size = collections.Counter(), {}, {}
    for r in found:
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.size
        assert r.taken <= 3 * r.size
    assert len(found) == len(rows)
    assert all(abs(taken[s] - target[s]) <= size[s] / 2 for s in target)
    assert collections.Counter(map(str, found)) == collections.Counter(map(str, mixing.mix(docs).collect()))
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_equal_texts_without_ids_are_split_among_shards(spark):
    rows = [(None, "same text again")] * 1000 + [(i, f"text number {i:05}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    load = collections.Counter()
    slots = collections.defaultdict(list)
    for r in sharding.assign(docs, shards=8).collect():
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(load) == 8 and max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == 3000


def test_repeated_labelled_rows_are_one_trial(spark):
    word = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    rows = [(i, word(i) + (" $$$$" * 40 if i % 6 == 0 else ""), "en") for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 6 != 0)) for i in range(240)], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    many = spark.createDataFrame(rows * 20, "doc_id long, text string, lang string").repartition(4)
    verdict = lambda docs: {(r.doc_id, r.kept) for r in quality.judge(docs, labels).collect()}
    assert verdict(once) == verdict(many)
