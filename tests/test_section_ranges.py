"""Attachment sections over ranges of a page's files, and what is written and joined for them."""
from pagewright import session
from pagewright.operators import attachments as att
from tests import test_requests

DETAIL = "page_id string, path string, ord long, attachment_id string, api_url string, name string, content_type string, uploaded boolean"


def detail(page, n):
    png = n % 3 == 0
    return (page, f"attachments/{page}/{n}_.{'png' if png else 'pdf'}", n, None if n % 5 == 0 else f"id{n}", f"https://kb/{page}/{n}_",
            f"n{n}", "image/png" if png else None, n % 7 != 0)


def sections(page, text, rows):
    """The whole section of a page, by plain loops."""
    up = sorted((r for r in rows if r[0] == page and r[7]), key=lambda r: r[2])
    loose = [r for r in up if r[1] not in text and r[4] not in text]
    out = "\n\n## Original Attachments\n\n" + ("### Unlinked Attachments\n\n" if loose else "")
    out += "".join(f"![{r[5]}]({r[4]})\n\n" if r[1].endswith("png") else f"- [{r[5]}]({r[4]})\n" for r in loose)
    out += ("\n" if loose else "") + "### Attachment Details\n\n"
    return out + "".join(f"- **Content Type:** {r[6] or ''} **Original Name:** {r[5]} **Uploaded UUID:** {r[3] or ''}\n" for r in up), len(loose), len(up)


def test_sections_of_pages_that_reach_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(att, "CHUNK", 10)
    rows = [detail("a", n) for n in range(1, 400)] + [detail("b", n) for n in range(1, 9)] + [detail("c", 3), detail("d", 7)]
    texts = {"a": "see attachments/a/4_.pdf and https://kb/a/8_", "b": "none", "c": "![](attachments/c/3_.png)", "d": "", "e": "no files"}
    written = []
    monkeypatch.setattr(session, "scratch_path", lambda s, name, real=session.scratch_path: written.append(name) or real(s, name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = att.section_chunks(spark.createDataFrame(list(texts.items()), "page_id string, content string"),
                                   spark.createDataFrame(rows, DETAIL).repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert written == ["section"]  # one row for each file, not its lines with their text as well
    for page, text in texts.items():
        mine = sorted((r.part, r.chunk, r.text) for r in found if r.page_id == page)
        want, loose, up = sections(page, text, rows)
        if not up:
            assert not mine
            continue
        assert "".join(t for _, _, t in mine) == want
        assert [(p, c) for p, c, _ in mine] == [(1, 0), *[(2, c) for c in range(-(-loose // 10))], (3, 0), *[(4, c) for c in range(-(-up // 10))]]


def test_details_are_worked_out_once_for_texts_and_sections(spark, monkeypatch):
    written = []
    monkeypatch.setattr(session, "scratch_path", lambda s, name, real=session.scratch_path: written.append(name) or real(s, name))
    rows = [detail("a", n) for n in range(1, 9)]
    files = spark.createDataFrame(rows, DETAIL)
    got = att.prepare_content(spark.createDataFrame([("a", "x"), ("b", "y")], "page_id string, content string"), files.select("page_id", "path"), files)
    assert written == ["usable", "contents", "section"]
    assert att.whole_texts(got.where("page_id = 'a'")).first().text == "x" + sections("a", "x", rows)[0]


def test_lists_files_and_details_meet_by_path_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(test_requests.phases, "stage",
                        lambda df, name, real=test_requests.phases.stage: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or real(df, name))
    got = test_requests.run(spark, [("a.png", None), ("b.pdf", False), ("gone.txt", False)], [("p", "p-id")])
    assert [k[1:] for k, _ in got] == [("attachment", "attachments/2/a.png"), ("attachment", "attachments/2/b.pdf"), ("update", None)]
    joined = dict(plans)["files"]
    assert joined.count("Join LeftOuter") == 2 and "sent" in joined and "tried" in joined
