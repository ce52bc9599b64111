"""Column functions that clean and read markdown; each row is one whole document."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions import fixed
from pagewright.functions.text import col, group, is_blank, let, strip, without_title_prefix

_CRUMBS = "array<struct<title:string,link:string>>"


def _lines(c) -> Column:
    return F.split(col(c), "\n", -1)


def _from_first(lines: Column, skipped) -> Column:
    """Lines from the first one that is not skipped; none when all are.

    The first lines nearly always decide; the rest is looked at only when they do not.
    """
    def first(part):
        return F.nullif(F.array_position(F.transform(part, lambda x: ~skipped(x)), True),
                        F.lit(0).cast("long"))

    def cut(x):
        start = F.coalesce(first(F.slice(x, 1, 16)), first(x), F.size(x) + F.lit(1).cast("long"))
        return let(start.cast("int"), lambda n: F.slice(x, n, F.size(x)))

    return let(lines, cut)


def _squash_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def clean_markdown(md) -> Column:
    """Remove conversion artefacts: leading breadcrumbs, empty items, page furniture."""
    def leading(line):
        s = strip(line)
        return ((s == "") | s.rlike(r"(?Ud)^\d+\.\s*\[.*?\]\(.*?\)\s*$")
                | s.rlike(r"(?U)^\d+\.\s*$"))

    out = F.array_join(_from_first(_lines(md), leading), "\n")
    out = _squash_newlines(out)
    out = F.regexp_replace(out, r"(?Umd)^\s*[\*\-\+]\s*$", "")
    out = F.regexp_replace(out, r"(?U)\|\s*\|", "|")
    out = F.regexp_replace(out, r"(?md)^Created by.*?modified.*?on.*?$", "")
    out = F.regexp_replace(out, rf"(?md)^{fixed.GENERATOR_LINE}.*?$", "")
    return _squash_newlines(out)


def post_process_markdown(md) -> Column:
    """The eight ordered rewrites applied after conversion of a legacy page."""
    out = _squash_newlines(col(md))
    out = F.regexp_replace(out, "(?U)" + fixed.EMPTY_LINK, "")
    out = F.regexp_replace(out, rf"(?i){fixed.GENERATOR_LINE} on [^\n]*\n*", "")
    out = F.regexp_replace(out, rf"(?iU)\[{fixed.VENDOR_LINK_TEXT}\]\([^)]*\)\s*", "")
    out = F.regexp_replace(out, r"(?s)Created by.*?(?=\n\n|\n#|\z)", "")
    out = F.regexp_replace(out, r"(?id)last modified by.*?on [^\n]*\n*", "")
    out = F.regexp_replace(out, r"(?U)\n(#{1,6}\s)", "\n\n$1")
    out = F.regexp_replace(out, r"(?U)[^\S\n]+(?=\n|\z)", "")
    return strip(out)


def clean_content_for_api(md) -> Column:
    """Drop breadcrumbs and repeated headings, shorten ``# Space : Title`` headings."""
    crumbs = r"(?Ud)^(\d+\\?\.\s*\[.*?\]\([^)]+\)\s*)+"
    one_crumb = r"(?U)^\d+\\?\.\s*\["
    prefixed = r"(?Ud)^(#+)\s*[^:]+\s*:\s*(.+)$"

    # 1: several breadcrumbs on one line; the rest of such a line stays if there is any
    kept = F.transform(_lines(md), lambda x: F.when(
        x.rlike(crumbs), F.nullif(strip(F.regexp_replace(x, crumbs, "")), F.lit(""))).otherwise(x))
    kept = F.filter(kept, lambda x: x.isNotNull())
    # 2: leading breadcrumb and blank lines
    kept = _from_first(kept, lambda x: let(strip(x), lambda s: s.rlike(one_crumb) | (s == "")))

    def is_heading(x):
        return x.rlike(r"(?U)^\s*#")

    # 3: a repeated heading gives way to the text after it, if any
    def heading_text(s):
        return strip(F.get(F.split(s, "#", -1), F.lit(1)))

    def step(state, h):
        parts = F.split(strip(h["raw"]), "#", -1)
        rest = strip(F.array_join(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), "#"))
        again = F.array_contains(state["seen"], heading_text(strip(h["raw"])))
        new = F.when(again, F.when(rest != "", F.concat(F.lit("# "), rest))).otherwise(h["raw"])
        return let(new, lambda n: F.struct(
            F.when(n.isNull(), state["seen"]).otherwise(
                F.concat(state["seen"], F.array(heading_text(strip(n))))).alias("seen"),
            F.concat(state["out"], F.array(n)).alias("out")))

    empty = F.array().cast("array<string>")

    def without_repeats(x):
        heads = F.filter(F.transform(x, lambda v, i: F.struct(i.alias("i"), v.alias("raw"))),
                         lambda h: is_heading(h["raw"]))

        def replaced(hs):
            folded = F.aggregate(hs, F.struct(empty.alias("seen"), empty.alias("out")), step)
            new_heads = F.map_from_arrays(F.transform(hs, lambda h: h["i"]), folded["out"])
            return let(new_heads, lambda m: F.filter(F.transform(
                x, lambda v, i: F.when(is_heading(v), m[i]).otherwise(v)), lambda v: v.isNotNull()))

        return let(heads, lambda hs: F.when(F.size(hs) < 2, x).otherwise(replaced(hs)))

    kept = let(kept, without_repeats)

    # 4: space prefixes in headings
    def shortened(x):
        return let(strip(x), lambda s: F.when(s.rlike(prefixed), F.concat(
            F.regexp_extract(s, prefixed, 1), F.lit(" "),
            strip(F.regexp_extract(s, prefixed, 2)))).otherwise(x))

    kept = F.transform(kept, lambda x: F.when(is_heading(x), shortened(x)).otherwise(x))
    return strip(_squash_newlines(F.array_join(kept, "\n")))


def parse_breadcrumb(md) -> Column:
    """Breadcrumb items of a page as an array of (title, link).

    Items may run over several lines. Once something was found, the first other line that is
    not a heading ends the list. State: items found, parts of an open title, finished flag.
    """
    none = F.array().cast(_CRUMBS)

    def step(s, raw):
        line = strip(raw)
        whole = line.rlike("(?U)" + fixed.BREADCRUMB_ITEM)
        opens = line.rlike("(?U)" + fixed.BREADCRUMB_OPEN)
        closes = line.rlike(fixed.BREADCRUMB_CLOSE)
        is_open = s["part"].isNotNull()

        def item(title, pattern):
            return F.array(F.struct(title.alias("title"),
                                    F.regexp_extract(line, pattern, 2).alias("link")))

        tail = F.concat_ws(" ", s["part"], F.regexp_extract(line, fixed.BREADCRUMB_CLOSE, 1))
        found = (F.when(s["done"], s["found"])
                 .when(is_open & closes, F.concat(s["found"], item(strip(tail), fixed.BREADCRUMB_CLOSE)))
                 .when(is_open, s["found"])
                 .when(whole, F.concat(s["found"], item(
                     F.regexp_extract(line, "(?U)" + fixed.BREADCRUMB_ITEM, 1),
                     "(?U)" + fixed.BREADCRUMB_ITEM)))
                 .otherwise(s["found"]))
        part = (F.when(s["done"], s["part"])
                .when(is_open & closes, F.lit(None).cast("string"))
                .when(is_open, F.concat_ws(" ", s["part"], line))
                .when(~whole & opens, F.regexp_extract(line, "(?U)" + fixed.BREADCRUMB_OPEN, 1)))
        done = s["done"] | (~is_open & ~whole & ~opens & (line != "")
                            & ~line.startswith("#") & (F.size(s["found"]) > 0))
        return F.struct(found.alias("found"), part.alias("part"), done.alias("done"))

    start = F.struct(none.alias("found"), F.lit(None).cast("string").alias("part"),
                     F.lit(False).alias("done"))
    return F.aggregate(_lines(strip(md)), start, step)["found"]


def breadcrumb_block(md) -> Column:
    """First block of numbered links, as text; empty when there is none."""
    return strip(F.regexp_extract(col(md), "(?msUd)" + fixed.BREADCRUMB_BLOCK, 1))


def page_path(crumbs) -> Column:
    """Titles from the third breadcrumb on: the first two are home and space."""
    c = col(crumbs)
    return F.transform(F.slice(c, 3, F.greatest(F.size(c), F.lit(1))), lambda x: x["title"])


def title_from_content(md) -> Column:
    """Text of the first heading or title span, without the space prefix."""
    header = "(?Ud)" + fixed.CLEAN_HEADER
    span = "(?U)" + fixed.TITLE_SPAN
    hit = F.get(F.filter(_lines(strip(md)), lambda x: strip(x).rlike(header) | x.rlike(span)),
                F.lit(0))
    title = strip(F.coalesce(group(strip(hit), header), group(hit, span)))
    return F.coalesce(F.regexp_replace(title, r"(?s)^.*? : ", ""), F.lit(""))


def title_from_markdown(md) -> Column:
    """Title by three patterns in order, without the organisation prefix."""
    found = F.coalesce(*[group(md, "(?miUd)" + p) for p in
                         (fixed.TITLE_SPAN, fixed.TITLE_SPAN_PREFIXED, fixed.MARKDOWN_HEADER)])
    return F.coalesce(without_title_prefix(strip(found)), F.lit(""))


def space_name_from_index(text, default: str = fixed.DEFAULT_SPACE_NAME) -> Column:
    """Name cell of the index table, else the words after ``Name |``, else the default."""
    cells = F.transform(
        F.filter(_lines(text), lambda x: strip(x).startswith("Name |")),
        lambda x: strip(F.get(F.split(x, r"\|", -1), F.lit(1))))
    cell = F.get(F.filter(cells, lambda x: x != ""), F.lit(0))

    flat = F.replace(F.replace(col(text), F.lit("\n"), F.lit(" ")), F.lit("  "), F.lit(" "))
    after = strip(F.regexp_extract(flat, r"(?s)^.*?Name \|(.*)$", 1))
    words = F.filter(F.split(after, r"(?U)\s+"), lambda w: w != "")
    stop = F.array_position(F.transform(words, lambda w: w.isin(fixed.SPACE_NAME_STOP_WORDS)), True)
    taken = F.when(stop > 0, F.slice(words, 1, (stop - 1).cast("int"))).otherwise(words)
    return F.coalesce(cell, F.nullif(F.array_join(taken, " "), F.lit("")), F.lit(default))


def attachment_refs(md) -> Column:
    """Distinct attachment paths referred to by images, file links or ``src`` attributes."""
    file_ref = rf"\[([^\]]+)\]\(([^)]+\.({fixed.ATTACHMENT_LINK_EXTENSIONS}))\)"
    found = [F.regexp_extract_all(col(md), F.lit("(?iU)" + p), F.lit(g))
             for p, g in ((fixed.IMAGE_REF, 2), (file_ref, 2), (fixed.SRC_REF, 1))]
    return F.array_distinct(F.filter(
        F.concat(*found), lambda x: x.contains("attachments/") | x.startswith("attachments")))


def clean_page_text(breadcrumb, title, content) -> Column:
    """Body of a cleaned file: breadcrumb, heading and content, blank parts left out."""
    return F.concat(
        F.when(is_blank(breadcrumb), "").otherwise(F.concat(col(breadcrumb), F.lit("\n\n"))),
        F.when(is_blank(title), "").otherwise(F.concat(F.lit("# "), col(title), F.lit("\n\n"))),
        F.coalesce(col(content), F.lit("")))
