"""All requests of a run, step by step, and one conversion a page."""
import json

from pyspark.sql import functions as F

from pagewright import phases

ITEM = ("space_key string, path array<string>, parent_path array<string>, pos int, title string, type string, md_content string, "
        "page_id string, page_uuid string, parent_uuid string, created boolean")


def run(spark, details=(), outcomes=None, files=("a.png", "b.pdf"), home="home"):
    rows = [("s", ["r"], None, 0, "r", "collection", "", "1", None, None, True),
            ("s", ["r", "p"], ["r"], 1, "p", "page", "see ![](attachments/2/a.png)", "2", None, None, False),
            ("s", ["r", "q"], ["r"], 2, "q", "page", "old", "3", "q-id", None, True)]
    paths = [("2", "attachments/2/a.png"), ("2", "attachments/2/b.pdf"), ("2", "attachments/2/gone.txt"), ("2", "attachments/2/a.png")]
    made = outcomes and spark.createDataFrame([("s", ["r", p], u) for p, u in outcomes], "space_key string, path array<string>, page_uuid string")
    got = phases.upload_requests(
        spark.createDataFrame(rows, ITEM), spark.createDataFrame([("q-id",)], "id string"),
        spark.createDataFrame([("s", "Space", home)], "space_key string, space_name string, collection_id string"),
        spark.createDataFrame(paths, "page_id string, path string"),
        spark.createDataFrame([("2", f"attachments/2/{f}", 5) for f in files], "page_id string, path string, size long"),
        spark.createDataFrame([("2", f"attachments/2/{f}", n, f"id{n}", f"https://kb/{f}" if ok else None, f, "image/png", ok)
                               for n, (f, ok) in enumerate(details)],
                              "page_id string, path string, ord int, attachment_id string, api_url string, name string, content_type string, uploaded boolean"),
        spark.createDataFrame([("2", rows[1][6])], "page_id string, content string"), made)
    return sorted(((r.step, r.kind, r.key), json.loads(r.request)) for r in got.collect())


def test_a_space_without_a_collection_comes_first(spark):
    assert [k for k, _ in run(spark, home=None)] == [(0, "collection", None)]


def test_documents_attachments_and_second_update_follow(spark):
    (kind, request), = run(spark)
    assert kind == (1, "document", None) and request["title"] == "p" and "Loading" in request["text"]
    new = [("p", "p-id")]
    got = run(spark, outcomes=new)                      # its files, each once; the missing one is no request
    assert [k[2] for k, _ in got] == ["attachments/2/a.png", "attachments/2/b.pdf"]
    assert all(r["documentId"] == "p-id" for _, r in got)
    got = run(spark, [("a.png", True)], new)            # the second is still open, so no update yet
    assert [k[2] for k, _ in got] == ["attachments/2/b.pdf"]
    got = run(spark, [("a.png", True), ("b.pdf", False)], new)  # one failed: it is tried again, the text is sent
    assert [k[1] for k, _ in got] == ["attachment", "update"]
    assert got[1][1]["id"] == "p-id" and "https://kb/a.png" in got[1][1]["text"]


def test_documents_of_earlier_runs_get_no_second_update(spark):
    got = run(spark, [("a.png", True), ("b.pdf", True)])
    assert [k[1] for k, _ in got] == ["document"]


def test_tables_of_attachments_are_worked_out_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(phases, "stage", lambda df, name, real=phases.stage: written.append(name) or real(df, name))
    got = run(spark, [("a.png", True)], [("p", "p-id")])
    assert sorted(written) == ["details", "files", "items", "listed", "plan"] and len(got) == 1


def test_a_page_is_converted_once(spark):
    items = spark.createDataFrame([("s", "t", "x.html"), ("s", "u", "y.html"), ("s", "v", None)], "space_key string, title string, html_page string")
    pages = spark.createDataFrame([("s", "x.html", "<html><body><div id='main-content'><p>Hi</p></div></body></html>"),
                                   ("s", "y.html", "")], "space_key string, href string, html string")
    got = phases.extract_content(items, pages)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    once = pages.select("space_key", F.col("href").alias("page_id"), "html")
    from pagewright.operators import dom
    assert plan.count("Generate") == dom.converted_pages(once)._jdf.queryExecution().optimizedPlan().toString().count("Generate")
    by = {r.title: r.md_content for r in got.collect()}
    assert by["t"] == "Hi" and "collection" in by["v"]
