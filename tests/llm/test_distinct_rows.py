"""One row of each component stays, whatever its id."""
from pagewright.llm import jaccard


def text(seed, extra=""):
    return " ".join(f"w{seed}x{i}" for i in range(60)) + extra


def test_exactly_one_row_of_each_component_stays(spark):
    rows = [(1, text(1))] * 50                                     # a repeated row
    rows += [(None, text(2))] * 5 + [(None, text(2, " more"))]     # copies without an id
    rows += [(3, text(3)), (9, text(3)), (9, text(4))]             # one id: a copy, and a text of its own
    rows += [(None, text(5)), (6, text(5)), (5, text(5))]          # ids come before none
    rows += [(None, ""), (None, None), (8, ""), (8, "")]           # without words: in no component
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, place long").repartition(4)
    kept = jaccard.distinct_documents(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "").split(" ")[0]) for r in kept.collect()), key=str)
    want = [(1, "w1x0"), (None, "w2x0"), (3, "w3x0"), (9, "w4x0"), (5, "w5x0"), (None, ""), (None, ""), (8, ""), (8, "")]
    assert got == sorted(want, key=str)
