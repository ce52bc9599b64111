"""Verdicts belong to rows, not to ids."""
from pagewright.llm import language

CLEAN = "the river runs under the old stone house and the green light of the water is with us"


def test_a_rejected_row_takes_no_clean_row_with_it(spark):
    rows = [(i, CLEAN + f" number {i}", "en", "s", i) for i in range(30)]
    rows += [(None, CLEAN, "en", "s", 100), (None, "", "en", "s", 101), (None, None, None, None, 102)]     # no id
    rows += [(7, "12 34", "en", "s", 103), (40, CLEAN, "en", "s", 104), (40, " ", "en", "s", 105)]         # one id
    rows += [(40, CLEAN, "en", "s", 106)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, place long").repartition(3)
    kept = language.known_language(docs)
    assert kept.columns == docs.columns
    assert sorted(r.place for r in kept.collect()) == [*range(30), 100, 104, 106]
