"""Thresholds rest on all held-out spans, however small a kind's share of them."""
import random

from pagewright.llm import pii


def test_a_kind_among_many_other_spans_keeps_its_threshold(spark):
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnoprstu") for _ in range(n))
    rows = [f"write to {word(6)}.{word(5)}@{word(7)}.org today" for _ in range(400)]
    rows += [" and ".join(str(rnd.randint(10 ** 8, 10 ** 15)) for _ in range(100)) for _ in range(300)]
    rows += ["write to x.y [at] example.org today"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    trees = pii.fit(pii.stage(pii.candidates(docs, "text"), "found"), sample_rows=800)
    assert pii.KINDS.index("email") in trees.thresholds
    added = {r.doc_id: r.added for r in pii.find(docs, sample_rows=800).collect()}
    assert [s.value for s in added[700]] == ["x.y [at] example.org"]


def test_repeated_spans_count_as_often_as_they_occur_but_prove_nothing_new(spark):
    rows = [(i, "mail a.b@example.org or 12345678 now") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trees = pii.fit(pii.stage(pii.candidates(docs, "text"), "found"))
    assert trees is None or not trees.thresholds
