"""Literal rows for names, cleaning and reference rules."""
import re

import pytest
from pyspark.sql import functions as F

from pagewright.functions import fixed, markdown as md, markup, refs, text


@pytest.fixture(scope="module")
def apply(spark):
    """Evaluate a column function on a list of rows given as tuples."""
    def run(fn, rows):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        names = [f"c{i}" for i in range(len(rows[0]))]
        schema = ", ".join(["i int"] + [f"{n} string" for n in names])
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
        out = df.select("i", fn(*names).alias("v")).orderBy("i").collect()
        return [r.v for r in out]

    return run


def test_named_patterns(apply):
    assert re.match(fixed.BREADCRUMB_ITEM, "1. [Title](link.html)")
    assert re.search(fixed.PAGE_ID_IN_FILENAME, "Title_2481520646.html")
    assert apply(text.without_title_prefix, ["Information Systems : Title", "information  systems: T"]) == ["Title", "T"]
    assert apply(text.detect_content_type, ["<!DOCTYPE html>", "<HTML>", "# md"]) == ["html", "html", "markdown"]


def test_names(apply):
    assert apply(text.zip_folder_name, ["z/Confluence-space-export-135853.html.zip", "My wiki (2).zip", "é_1.zip"]) == [
        "Export-135853", "My-wiki-2", "é_1"]
    guard = lambda m: text.zip_member_guard(m, F.lit(5))
    assert apply(guard, ["a..b.txt", "/abs", "ok.txt", "x" * 256]) == [
        "suspicious path", "suspicious path", None, "name too long"]
    assert apply(lambda m: text.zip_member_guard(m, F.lit(10 ** 9)), ["ok"]) == ["file too large"]
    assert apply(text.extension, ["a/b.TAR.GZ", ".hidden", "none", "x.y/z"]) == [".gz", "", "", ""]
    assert text.allowed_extensions(include="svg, .png,,", override=None)[-1] == ".svg"
    assert text.allowed_extensions(override="csv , .x") == [".csv", ".x"]
    assert apply(text.page_id_from_href, ["A_12345678.html", "12345678", "A_1234567.html", "12345678.htm"]) == [
        "12345678", "12345678", None, None]
    assert apply(text.page_id_from_name, ["Customer#000000001_300000001.html", "x"]) == ["000000001", None]
    assert apply(text.page_id_from_filename, ["clean_3CX_2481520646.html", "77.md", "a.html", "x_5.htm"]) == [
        "2481520646", "77", "", "5"]


def test_title_from_html(apply):
    rows = [("<TITLE>\n A <b>big</b>\n page </title>", "x.html"), ("<title>ab</title><h1>Long one</h1>", "x"),
            ("none", "my_first-PAGE.html"), ("", "")]
    assert apply(text.title_from_html, rows) == ["A big page", "Long one", "My First Page", "Untitled Document"]


def test_entities(apply):
    rows = ["a &amp;lt; b", "&#8217;&#x1F600;&eacute;", "&nosuch; & &amp", "&#0;", "plain"]
    assert apply(markup.decode_entities, rows) == ["a &lt; b", "’😀é", "&nosuch; & &amp", "�", "plain"]


def test_attribute_map(apply):
    got = apply(markup.attribute_map, ['<a HREF="x?a=1&amp;b=2" title=\'t "q"\' data-x=5 href="y">', "<p>"])
    assert got == [{"href": "y", "title": 't "q"', "data-x": "5"}, {}]


def test_clean_markdown(apply):
    rows = ["1. [a](b)\n\n2. \n\ntext\n\n\n\nmore\n *\nlast",
            "a |  | b |\n| c",  # white space between bars may hold a line feed
            "x\nCreated by A, modified by B on day\ny\nDocument generated by Confluence on z", "\n\n"]
    got = apply(md.clean_markdown, rows)
    assert got[0] == "text\n\nmore\n\nlast"
    assert got[1] == "a | b | c"
    assert got[2] == "x\n\ny\n"
    assert got[3] == ""


def test_many_leading_lines_are_skipped(apply):
    assert apply(md.clean_markdown, ["\n" * 200 + "1. [x](y)\n" * 50 + "end"]) == ["end"]


def test_post_process(apply):
    rows = ["a  \n[](u)b\nlast modified by X on 2020\n# H\nCreated by me\nand you\n\nkeep [Atlassian](http://a) z"]
    assert apply(md.post_process_markdown, rows) == ["a\nb\n\n# H\n\n\nkeep z"]


def test_clean_content_for_api(apply):
    rows = [
        "1. [a](b) 2. [c](d) # Space : Title\ntext",
        "1. [a](b)\n\n# T\n\n# T # more\n# T\n## sub\n# more # again\nend",
        "no heading",
    ]
    got = apply(md.clean_content_for_api, rows)
    assert got[0] == "# Title\ntext"
    assert got[1] == "# T\n\n# more\n## sub\n# again\nend"
    assert got[2] == "no heading"


def test_breadcrumb(apply):
    rows = ["1. [Home](i.html)\n2. [A\nlong\ntitle](a.html)\n\n# H\nstop\n3. [no](n.html)",
            "text first\n1. [x](y)", "1. [open\nnever closed", ""]
    got = apply(md.parse_breadcrumb, rows)
    assert [[(c.title, c.link) for c in r] for r in got] == [
        [("Home", "i.html"), ("A long title", "a.html")], [("x", "y")], [], []]
    path = apply(lambda c: md.page_path(md.parse_breadcrumb(c)), ["1. [a](b)\n2. [c](d)\n3. [e](f)\n4. [g](h)", "x"])
    assert path == [["e", "g"], []]


def test_titles_from_markdown(apply):
    assert apply(md.title_from_content, ["x\n# S : T : U\n# V", 'y # <span id="title-text"> A : B </span>', "none"]) == [
        "T : U", "B", ""]
    assert apply(md.title_from_markdown, ["# Head {#id}\n", '# <span id="title-text">Information Systems : Q </span>', "-"]) == [
        "Head", "Q", ""]
    assert apply(md.space_name_from_index, ["Name | | x\n", "Key ---|--- Name | Two Words Pages: z", "-"]) == [
        "| x", "Two Words", "Information Systems"]


def test_attachment_refs(apply):
    rows = ["![a](attachments/1/a.png) [f](attachments/1/b.PDF) [g](attachments/1/c.bin) <img src='x/attachments/d'> ![a](attachments/1/a.png)"]
    assert apply(md.attachment_refs, rows) == [["attachments/1/a.png", "attachments/1/b.PDF", "x/attachments/d"]]


def test_reference_rules_with_special_characters(apply):
    p, url, name = "attachments/1/a+(1)$.png", "https://k/a?id=$1\\2", "a.b$.png"
    img = lambda c: refs.replace_image(c, F.lit(p), F.lit(url), F.lit(name))
    assert apply(img, [f"![x]({p}) ![]({p}) ({p})", f'![x]({p} " =30x40")']) == [
        f"![x]({url}) ![a.b$]({url}) ![a.b$]({url})", f'![x]({url} " =30x40")']
    tpl = lambda c: refs.replace_templated_image(c, F.lit(p), F.lit(url), F.lit(name))
    assert apply(tpl, ["![x]({%s}) ![]({%s}) {%s}" % (p, p, p)]) == [f"![x]({url}) ![a.b$]({url}) {{{p}}}"]
    doc = lambda c: refs.replace_doc(c, F.lit("attachments/1/d.pdf"), F.lit("u"), F.lit("d.pdf"))
    assert apply(doc, ["[t](attachments/1/d.pdf) (attachments/1/d.pdf) attachments/1/d.pdf"]) == ["[t](u) (u) [d.pdf](u)"]


def test_default_content(spark):
    df = spark.createDataFrame([("T", None, False, None), ("T", "p.html", False, None), ("T", "p.html", True, "md")],
                               "t string, p string, e boolean, m string")
    got = [r[0] for r in df.select(text.default_content("t", "p", "e", "m")).collect()]
    assert got == ["# T\n\nThis is a collection page.", "# T\n\nContent not found.", "md"]
