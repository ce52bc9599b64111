"""Quirks of the source format, invariants, and skewed inputs against brute force."""
import random

import pytest
from pyspark.sql import functions as F

from pagewright.operators import archives, attachments as att, dom, status, sync, tree
from pagewright.operators.numbering import number_rows

LINK = "space_key string, pos long, title string, path array<string>, href string, page_id string, hierarchy_level int"


def links(spark, rows):
    return spark.createDataFrame([("s", p, t, path, f"{t}.html", str(p), len(path)) for p, t, path in rows], LINK)


# ---------------------------------------------------------------- trees

def test_last_record_wins_at_first_position(spark):
    got = tree.dedupe_paths(links(spark, [(1, "a", ["x"]), (2, "b", ["y"]), (3, "c", ["x"])])).orderBy("pos").collect()
    assert [(r.pos, r.title) for r in got] == [(1, "c"), (2, "b")]


def test_orphans_and_unlisted_links_leave_the_tree(spark):
    l = links(spark, [(1, "a", ["a"]), (2, "b", ["a", "b"]), (3, "o", ["gone", "o"]), (4, "p", ["gone", "o", "p"]), (5, "z", [])])
    nodes = tree.build_tree(l)
    assert {tuple(r.path) for r in nodes.collect()} == {("a",), ("a", "b")}
    assert {tuple(r.path) for r in tree.orphans(tree.dedupe_paths(l)).collect()} == {("gone", "o")}
    stats = tree.structure_stats(l, nodes).collect()[0]
    assert (stats.total_links_found, stats.total_pages, stats.total_navigation_nodes, stats.max_depth, stats.unique_paths) == (5, 1, 1, 3, 5)


def test_tree_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, f"t{i}", [rng.choice("abc") for _ in range(rng.randint(1, 4))]) for i in range(120)]
    paths = {tuple(p) for _, _, p in rows}
    reach = {p for p in paths if all(p[:i] in paths for i in range(1, len(p)))}
    nodes = tree.build_tree(links(spark, rows)).collect()
    assert {tuple(r.path) for r in nodes} == reach
    assert {tuple(r.path) for r in nodes if r.type == "navigation"} == {p for p in reach if any(q[:-1] == p for q in reach)}
    sizes = {tuple(r.path): r.items for r in tree.subtree_sizes(tree.build_tree(links(spark, rows))).collect()}
    assert sizes == {p: sum(q[:len(p)] == p for q in reach) for p in reach}


def test_first_links_limit_before_the_shuffle(spark):
    plan = tree.first_k_links(links(spark, [(i, f"t{i}", ["a"]) for i in range(30)]))
    assert plan.count() == 10
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- numbering under skew

def test_numbering_is_exact_when_one_group_holds_a_third(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("g"),
                                   (F.hash("id") % 5000).alias("v"), "id")
    got = number_rows(df, ["g"], ["v", "id"]).toPandas().sort_values(["g", "v", "id"])
    assert (got.groupby("g").cumcount() + 1 == got.rn).all()
    whole = number_rows(df, [], ["id"])
    assert whole.where("rn <> id + 1").count() == 0


def test_milestones(spark):
    e = spark.range(1, 9).select(F.col("id").alias("seq"))
    assert [(r.seq, r.percent) for r in status.progress_milestones(e).orderBy("seq").collect()] == [
        (2, 25.0), (4, 50.0), (6, 75.0), (8, 100.0)]


# ---------------------------------------------------------------- pages

def pages(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")


def markdown(spark, *htmls):
    return [r.markdown for r in dom.html_to_markdown(pages(spark, *htmls)).orderBy("page_id").collect()]


def test_page_rules(spark):
    got = markdown(
        spark,
        # both id and class must match; classes match as substrings; the first header and footer go
        '<body><div id="breadcrumb">kept</div><div id="breadcrumb" class="navigation">gone</div>'
        '<div class="unavailable">gone too</div><nav>no class, stays</nav><div id="footer">gone</div></body>',
        # the most specific content element wins wherever it stands
        '<body><div id="content">x</div><div class="a wiki-content">most</div></body>',
        "<p>no body</p>", "", None,
        # a leading list that links to the index is a breadcrumb, another list is not
        '<body><ol><li><a href="index.html">i</a></li></ol><ol><li>one</li><li>two<ul><li>deep</li></ul></li></ol></body>',
        '<body><a href="attachments/1/a.pdf?v=2">f</a> <img src="../attachments/1/b.png" alt="p"> <b>bold <i>it</i></b> <b>open</body>',
        "<body><pre>a  b\n <b>c</b></pre><p>x<br>y</p><!-- no --><script>var t='<p>';</script>&lt;tag&gt;</body>")
    assert got[0] == "kept\n\nno class, stays"
    assert got[1] == "most"
    assert got[2:5] == [f"Could not extract content from {i}" for i in (2, 3, 4)]
    assert got[5] == "1. one\n  2. two\n\n    * deep"
    assert got[6] == "[f]({attachments/1/a.pdf}) ![p]({../attachments/1/b.png}) **bold _it_** open"
    assert got[7] == "```\na  b\n c\n```\n\nx  \ny\n\n<tag>"


def test_file_name_of_a_lost_page(spark):
    df = pages(spark, "<p>x</p>", "<body>ok</body>").withColumn("file", F.lit("F.html"))
    got = {r.page_id: r.markdown for r in dom.html_to_markdown(df, "file").collect()}
    assert got == {0: "Could not extract content from F.html", 1: "ok"}


def test_path_takes_the_first_anchor_of_each_list(spark):
    html = ('<body><ul><li><a href="a_1.html">A</a></li><li><a href="b.html">B</a><ul><li><a href="c.html">C</a></li></ul></li></ul>'
            '<ul><ul><li><a href="d.html">D</a></li></ul><li><a href="e.html">E</a></li></ul></body>')
    got = {r.title: r.path for r in dom.link_paths(dom.html_tokens(pages(spark, html))).collect()}
    # C hangs below A, the first anchor of its outer list; D takes E, which follows its own list
    assert got == {"A": ["A"], "B": ["B"], "C": ["A", "C"], "D": ["E", "D"], "E": ["E"]}


def brute_paths(html):
    """Path rule by walking a small tree of lists: (title → path)."""
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__()
            self.stack, self.out, self.seq, self.a = [], [], 0, None

        def handle_starttag(self, tag, attrs):
            if tag == "ul":
                self.stack.append({"anchors": []})
            elif tag == "a":
                self.a = {"seq": self.seq, "t": "", "chain": list(self.stack)}
                self.seq += 1

        def handle_endtag(self, tag):
            if tag == "ul":
                self.stack.pop()
            elif tag == "a":
                for u in self.a["chain"]:
                    u["anchors"].append(self.a)
                self.out.append(self.a)

        def handle_data(self, d):
            if self.a is not None:
                self.a["t"] += d

    p = P()
    p.feed(html)
    paths = {}
    for a in p.out:
        parts = []
        for outer, inner in zip(a["chain"], a["chain"][1:]):
            first = next((x for x in outer["anchors"] if inner not in x["chain"]), None)
            if first:
                parts.append(first["t"])
        paths[a["t"]] = parts + ([a["t"]] if a["chain"] else [])
    return paths


def test_paths_against_brute_force(spark):
    rng = random.Random(3)
    htmls = []
    for _ in range(40):
        depth, out, n = 0, "<body>", 0
        for _ in range(rng.randint(3, 25)):
            step = rng.random()
            if step < 0.35:
                out, depth = out + "<ul>", depth + 1
            elif step < 0.6 and depth:
                out, depth = out + "</ul>", depth - 1
            else:
                out, n = out + f'<li><a href="p{n}.html">t{n}</a></li>', n + 1
        htmls.append(out + "</ul>" * depth + "</body>")
    got = {}
    for r in dom.link_paths(dom.html_tokens(pages(spark, *htmls))).collect():
        got.setdefault(r.page_id, {})[r.title] = r.path
    assert got == {i: b for i, b in ((i, brute_paths(h)) for i, h in enumerate(htmls)) if b}


def test_legacy_page(spark):
    html = ('<html><head><title>T</title></head><body><div id="breadcrumb-section"><ol id="breadcrumbs"><li><a href="i.html"> Home </a> x <a href="j">no</a></li>'
            '<li>plain</li><li><a href="s.html">S</a></li></ol></div><h1 id="title-heading"><span id="title-text">Information Systems : Q</span></h1>'
            '<p> </p><p>body <a href="http://www.atlassian.com/x">v</a></p><section><p>Document generated by Confluence on x</p><p>y</p></section></body></html>')
    r = dom.legacy_pages(pages(spark, html)).collect()[0]
    assert r.title == "Q" and r.breadcrumb == "1.  [Home](i.html)\n3.  [S](s.html)"
    assert r.markdown.split() == ["body", "y"]


def test_metadata_last_row_wins(spark):
    html = ("<table><tr><th>Key:</th><td> IS </td></tr><tr><td>Name</td><td>Some <i>Space</i></td></tr><tr><td>Key</td><td>K2</td><td>x</td></tr>"
            "<tr><td>alone</td></tr></table><table><tr><td>Name</td><td>second</td></tr></table>")
    r = dom.space_metadata(dom.html_tokens(pages(spark, html))).collect()[0]
    assert (r.space_key, r.space_name, r.description, r.created_by) == ("K2", "SomeSpace", None, None)


# ---------------------------------------------------------------- attachments

DETAIL = ("page_id string, path string, ord long, attachment_id string, api_url string, name string, "
          "content_type string, uploaded boolean")


def test_section_whenever_anything_is_uploaded(spark, monkeypatch):
    monkeypatch.setattr(att, "CHUNK", 2)
    d = spark.createDataFrame([("p", f"attachments/p/{i}.{e}", i, f"id{i}", f"u{i}", f"{i}.{e}", t, True) for i, (e, t) in enumerate(
        [("png", "image/png"), ("pdf", "application/pdf"), ("bin", ""), ("gif", "image/gif")])]
        + [("q", "attachments/q/x.pdf", 1, None, None, "x.pdf", "", False)], DETAIL)
    c = spark.createDataFrame([("p", "see {attachments/p/1.pdf}"), ("q", "none"), ("r", "free")], "page_id string, content string")
    listed = d.select("page_id", "path")
    rows = att.prepare_content(c, listed, d).orderBy("page_id", "part", "chunk").collect()
    text = {}
    for r in rows:
        text[r.page_id] = text.get(r.page_id, "") + r.text
    assert text["q"] == "none" and text["r"] == "free"
    assert text["p"] == (
        "see u1\n\n## Original Attachments\n\n### Unlinked Attachments\n\n![0.png](u0)\n\n- [2.bin](u2)\n![3.gif](u3)\n\n\n"
        "### Attachment Details\n\n" + "".join(
            f"- **Content Type:** {t} **Original Name:** {n} **Uploaded UUID:** id{i}\n"
            for i, (n, t) in enumerate([("0.png", "image/png"), ("1.pdf", "application/pdf"), ("2.bin", ""), ("3.gif", "image/gif")])))


def test_prefix_paths_are_replaced_in_order(spark):
    d = spark.createDataFrame([("p", "attachments/p/a.doc", 1, "x", "U1", "a.doc", "", True),
                               ("p", "attachments/p/a.docx", 2, "y", "U2", "a.docx", "", True)], DETAIL)
    c = spark.createDataFrame([("p", "(attachments/p/a.docx)")], "page_id string, content string")
    assert att.replace_refs(c, d).collect()[0].content == "([a.doc](U1)x)"


# ---------------------------------------------------------------- sync

ITEM = ("space_key string, path array<string>, parent_path array<string>, pos long, title string, page_uuid string, "
        "created boolean, md_content string")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(["R"], 1, None, False), (["R", "a"], 2, "d1", True), (["R", "b"], 3, None, True), (["R", "c"], 4, "gone", True),
            (["R", "e"], 5, "d2", False), (["R", "a", "x"], 6, None, False), (["T"], 7, "", True)]
    return spark.createDataFrame([("s", p, p[:-1], n, p[-1], u, c, "") for p, n, u, c in rows], ITEM)


def actions(spark, items, force):
    docs = spark.createDataFrame([("d1",), ("d2",), ("col",)], "id string")
    spaces = spark.createDataFrame([("s", "col")], "space_key string, collection_id string")
    return {r.title: r.action for r in sync.sync_action(items, docs, spaces, force).collect()}


def test_actions(spark, items):
    assert actions(spark, items, False) == {"R": "space_root", "a": "skip", "b": "skip", "c": "create", "e": "create", "x": "create", "T": "skip"}
    assert actions(spark, items, True) == {"R": "space_root", "a": "update", "b": "create", "c": "create", "e": "create", "x": "create", "T": "create"}


def test_waves_parents_and_failed_subtrees(spark, items):
    assert {r.title: r.wave for r in sync.sync_waves(items).collect()} == {"R": 0, "a": 1, "b": 1, "c": 1, "e": 1, "x": 2, "T": 1}
    assert {r.title: r.parent_uuid for r in sync.with_parent_uuid(items).collect() if r.parent_uuid} == {"x": "d1"}
    failed = items.where("title = 'a'")
    assert {r.title for r in sync.attempted_items(items, failed).collect()} == {"R", "a", "b", "c", "e", "T"}


def test_reset_is_idempotent(items):
    items = items.withColumn("parent_uuid", F.lit("p"))
    once = sync.reset_state(items, ["s"])
    assert sorted(map(str, once.collect())) == sorted(map(str, sync.reset_state(once, ["s"]).collect()))
    assert once.where("created or page_uuid is not null").count() == 0


def test_retry_rules(spark):
    rows = [("a", n, 429, False, None) for n in range(6)] + [("b", 0, 429, False, 120.0), ("b", 1, None, True, None), ("b", 2, 200, False, None),
            ("b", 3, 500, False, None), ("c", 0, 404, False, None), ("d", 0, 429, False, None)] + [("e", n, None, True, None) for n in range(6)]
    df = spark.createDataFrame(rows, "request_id string, attempt int, status_code int, network_error boolean, retry_after double")
    d = {(r.request_id, r.attempt): r.delay for r in sync.retry_schedule(df, 0.5).collect()}
    assert [d["a", n] for n in range(6)] == [1.5, 2.5, 4.5, 8.5, 16.5, None]
    assert d["b", 0] == 120.0 and d["b", 1] == 2.0 and d["e", 4] == 5.0
    live = sync.live_attempts(df)
    assert live.where("request_id = 'b'").count() == 3
    out = {r.request_id: (r.outcome, r.attempts) for r in sync.retry_outcome(df).collect()}
    assert out == {"a": ("rate_limited", 6), "b": ("succeeded", 3), "c": ("error", 1), "d": ("open", 1), "e": ("network_error", 6)}


def test_archive_guard_order(spark):
    df = spark.createDataFrame([("a", f"m{i}", 10) for i in range(5)] + [("b", "m", 1000), ("c", "../m", 1), ("c", "n", 1)],
                               "zip_file string, member string, file_size long")
    got = {r.zip_file: (r.success, r.files_extracted, r.files_blocked, r.error) for r in
           archives.extraction_summary(df, max_files=4, max_total_size=40).collect()}
    assert got == {"a": (False, 0, 0, "Archive contains too many files (5 > 4)"),
                   "b": (False, 0, 0, "Archive too large when uncompressed (1000 bytes)"), "c": (True, 1, 1, None)}
    assert {r.member for r in archives.admitted(df, max_files=4, max_total_size=40).collect()} == {"n"}


# ---------------------------------------------------------------- keys and nulls of the sync steps

def test_numbering_splits_equal_values_and_keeps_null_groups(spark):
    df = spark.range(4000).select(F.lit(None).cast("string").alias("g"), F.lit(1).alias("v"), "id")
    got = number_rows(df, ["g"], ["v", "id"])
    assert got.where("rn <> id + 1").count() == 0 and got.count() == 4000


def test_cross_references_stay_in_their_space(spark):
    from pagewright.operators import sync
    contents = spark.createDataFrame([("A", 1, "[h](Home.html)"), ("B", 1, "[h](Home.html)")],
                                     "space_key string, page_id long, content string")
    uuids = spark.createDataFrame([("A", "Home.html", "ua"), ("B", "Home.html", "ub")],
                                  "space_key string, href string, page_uuid string")
    got = {r.space_key: r.content for r in sync.cross_reference_update(contents, uuids, "u").collect()}
    assert got == {"A": "[h](u/doc/ua)", "B": "[h](u/doc/ub)"}


def test_verification_tells_null_texts_from_absent_documents(spark):
    from pagewright.operators import sync
    items = spark.createDataFrame([("a", None), ("b", None), ("c", "x")], "page_uuid string, md_content string")
    remote = spark.createDataFrame([("a", None), ("b", "y"), ("d", None)], "id string, text string")
    got = {r.id: r.verdict for r in sync.verify_upload(items, remote).collect()}
    assert got == {"a": "equal", "b": "changed", "c": "missing", "d": "extra"}


def test_children_wait_for_a_parent_that_is_created_anew(spark):
    items = spark.createDataFrame(
        [("s", ["r"], [], "old-r", "space_root"), ("s", ["r", "a"], ["r"], "stale", "create"), ("s", ["r", "a", "x"], ["r", "a"], None, "create"),
         ("s", ["r", "b"], ["r"], "known", "skip"), ("s", ["r", "b", "y"], ["r", "b"], None, "create")],
        "space_key string, path array<string>, parent_path array<string>, page_uuid string, action string").withColumn("pos", F.size("path").cast("long"))
    got = {r.path[-1]: (r.parent_uuid, r.waits_for_parent) for r in sync.with_parent_uuid(items).collect()}
    assert got == {"r": (None, False), "a": (None, False), "x": (None, True), "b": (None, False), "y": ("known", False)}
