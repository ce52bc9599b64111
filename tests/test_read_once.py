"""Spaces and links of index pages are worked out once."""
from pagewright import phases


def test_spaces_and_links_are_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(phases, "stage", lambda df, name, real=phases.stage: written.append(name) or real(df, name))
    html = '<html><body><ul><li><a href="a_10000001.html">A</a></li></ul></body></html>'
    index = spark.createDataFrame([(1, "Export-1", "F1", html)], "page_id long, export string, folder string, html string")
    files = spark.createDataFrame([(1, "a_10000001.html")], "page_id long, href string")
    headers, items = phases.process_input(index, files)
    assert written == ["spaces", "links"]
    assert [(r.title, r.html_page) for r in items.collect()] == [("A", "a_10000001.html")]
    assert headers.first().total_links_found == 1
