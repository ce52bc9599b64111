"""Lists of the same nodes are one list."""
from pagewright.llm import jaccard


def test_shared_tokens_of_the_same_copies_are_listed_once(spark, monkeypatch):
    listed = []

    def stage(df, name, real=jaccard.stage):
        out = real(df, name)
        if name == "listed":
            listed.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stage", stage)
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(1, text), (2, text + " end"), (3, text + " end"), (4, " ".join(f"v{i}" for i in range(300))), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard.join(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    assert listed == [2]  # two distinct texts share dozens of tokens, all in one list
