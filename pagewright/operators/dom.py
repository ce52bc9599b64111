"""HTML pages as a token table, and the page operators on it.

Every step groups by ``page_id`` first. ``html_tokens`` shuffles the raw pages once by that
key, before they are exploded; the windows and aggregates that follow find their rows
already in place and only sort. All groups are bounded by the size of one page row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import fixed, markup
from pagewright.functions.markdown import clean_markdown
from pagewright.functions.text import col, let, page_id_from_href, strip, without_title_prefix
from pagewright.session import small_partitions


def html_tokens(pages: DataFrame, attributes: bool = True, keep_empty: bool = False) -> DataFrame:
    """(page_id, pos, kind, name, attrs, text): one row per tag or text run, in order.

    Attribute values and text are decoded here, once for all that follows.

    The number of tasks follows the pages: AQE joins small partitions up to its advisory size,
    which ``session.small_partitions`` sets low for this job, since the tokens of a page need many
    times the room of its source. A fixed number of tasks would spill more with every page.
    ``keep_empty`` leaves one row of nulls for pages without any token.
    """
    small_partitions(pages.sparkSession)
    explode = F.posexplode_outer if keep_empty else F.posexplode
    exploded = (pages.select("page_id", "html").repartition("page_id")
                .select("page_id", explode(markup.split_tokens("html")).alias("pos", "token"))
                .withColumn("name", markup.tag_name("token"))
                .withColumn("kind", markup.token_kind("token", "name")))
    is_tag = F.col("kind").isin("open", "void") & F.col("token").contains("=")
    attrs = F.when(is_tag, markup.attribute_map("token"))
    text = markup.decode_entities(F.when(F.col("kind") == "text", F.col("token")))
    out = exploded.withColumn("attrs", attrs) if attributes else exploded
    return out.withColumn("text", text).drop("token")


PAGE_END = 2147483647  # end of an element that is never closed


def attr(name: str, source="attrs") -> Column:
    return col(source)[name]


def _in_order(*keys: str):
    return Window.partitionBy("page_id", *keys).orderBy("pos")


def _page(*keys: str):
    return Window.partitionBy("page_id", *keys)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def match_tags(tokens: DataFrame, marks: dict[str, Column] | None = None) -> DataFrame:
    """Add ``depth`` (per tag name), and the partner of each tag: ``partner``, ``opener``.

    An open tag's partner is the next token of the same name and depth, if that is a close
    tag; ``opener`` carries the attributes of the matching open tag to its close tag.
    Unclosed elements have no partner and end with the page. Each mark, a condition on open
    tags, becomes a flag, and ``<mark>_end`` flags the close tags of marked elements.
    """
    marks = marks or {}
    delta = F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)
    level = F.sum(delta).over(_in_order("name"))
    tagged = tokens.withColumns({m: _flag(c) for m, c in marks.items()}) if marks else tokens
    tagged = tagged.withColumn("depth", F.when(F.col("kind") == "close", level + 1)
                               .when(F.col("kind") == "open", level))
    same = _in_order("name", "depth")
    is_open, is_close = F.col("kind") == "open", F.col("kind") == "close"
    closes = is_close & (F.col("_prev.kind") == "open")
    return (tagged
            .withColumns({"_next": F.lead(F.struct("pos", "kind")).over(same),
                          "_prev": F.lag(F.struct("pos", "kind", "attrs", *marks)).over(same)})
            .withColumns({
                "partner": F.when(is_open & (F.col("_next.kind") == "close"), F.col("_next.pos"))
                .when(closes, F.col("_prev.pos")),
                "opener": F.when(closes, F.col("_prev.attrs")),
                **{f"{m}_end": _flag(closes & F.col(f"_prev.{m}")) for m in marks}})
            .drop("_next", "_prev"))


def html_elements(tokens: DataFrame) -> DataFrame:
    """(page_id, name, start, end, id, class): spans of elements, ``end`` null if unclosed."""
    return (match_tags(tokens).where("kind = 'open'")
            .select("page_id", "name", F.col("pos").alias("start"), F.col("partner").alias("end"),
                    attr("id").alias("id"), attr("class").alias("class")))


# ---------------------------------------------------------------- links and paths

def _marks(tokens: DataFrame) -> DataFrame:
    """List tags and anchors of each page: (page_id, pos, kind, name, href, title).

    Text runs join the last anchor opened before them if it is still open (anchors do not
    nest); an anchor's title is its runs, each stripped, without a separator.
    """
    is_a = F.col("name") == "a"
    slim = (tokens.where(F.col("name").isin("a", "ul") | (F.col("kind") == "text"))
            .select("page_id", "pos", "kind", "name", attr("href").alias("href"), "text"))
    slim = slim.withColumns({
        "_open": F.last(F.when(is_a & (F.col("kind") == "open"), F.col("pos")), ignorenulls=True).over(_in_order()),
        "_close": F.last(F.when(is_a & (F.col("kind") == "close"), F.col("pos")), ignorenulls=True).over(_in_order())})
    slot = (F.when(F.col("name") == "ul", F.col("pos"))
            .when(F.col("_open") > F.coalesce("_close", F.lit(-1)), F.col("_open")))
    own = F.col("pos") == F.col("slot")
    run = F.when(F.col("kind") == "text", F.struct("pos", strip(F.col("text")).alias("t")))
    return (slim.withColumn("slot", slot).where("slot is not null").groupBy("page_id", "slot")
            .agg(F.max(F.when(own, F.col("kind"))).alias("kind"), F.max(F.when(own, F.col("name"))).alias("name"),
                 F.max(F.when(own, F.col("href"))).alias("href"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(run)), lambda r: r["t"]), "").alias("title"))
            .withColumnRenamed("slot", "pos"))


def anchors(tokens: DataFrame) -> DataFrame:
    """(page_id, pos, href, title): all anchors with an href, text possibly empty."""
    return (_marks(tokens).where("name = 'a' and href is not null")
            .select("page_id", "pos", "href", "title"))


def html_links(tokens: DataFrame) -> DataFrame:
    """Anchors to ``.html`` files with a non-empty title, and the page id in the href."""
    return (anchors(tokens).where(F.col("href").endswith(".html") & (F.col("title") != ""))
            .withColumn("link_page_id", page_id_from_href("href")))


def with_ul_depth(tokens: DataFrame) -> DataFrame:
    """Add ``ul_depth``, the number of lists open around each token."""
    is_ul = F.col("name") == "ul"
    delta = (F.when(is_ul & (F.col("kind") == "open"), 1)
             .when(is_ul & (F.col("kind") == "close"), -1).otherwise(0))
    return tokens.withColumn("ul_depth", F.sum(delta).over(_in_order()).cast("int"))


def ul_depth(tokens: DataFrame) -> DataFrame:
    """(page_id, pos, href, ul_depth) of every anchor."""
    return (with_ul_depth(tokens)
            .where((F.col("kind") == "open") & (F.col("name") == "a") & attr("href").isNotNull())
            .select("page_id", "pos", attr("href").alias("href"), "ul_depth"))


def link_paths(tokens: DataFrame) -> DataFrame:
    """``.html`` links with their path: one title per list around them, own title last.

    The title a list gives to the links of a list inside it is the first ``.html`` anchor of
    the outer list that does not lie in the inner one. It depends on the pair of lists only,
    so it is worked out once per inner list, by looking ahead in document order. The lists
    around a list or link are found by an as-of window per level (the last list opened there
    before it), in one pass over the marks, instead of a containment join.
    """
    html_link = (F.col("name") == "a") & F.col("href").endswith(".html")
    is_list = F.col("name") == "ul"
    delta = (F.when(is_list & (F.col("kind") == "open"), 1)
             .when(is_list & (F.col("kind") == "close"), -1).otherwise(0))
    # backwards and over preceding rows: a frame of following rows would be quadratic
    ahead = Window.partitionBy("page_id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    marks = _marks(tokens).withColumns({
        "depth": F.sum(delta).over(_in_order()).cast("int"),
        "_next": F.last(F.when(html_link, F.struct("pos", "title")), ignorenulls=True).over(ahead)})
    # a close tag belongs to the level it leaves; what follows it goes to its open tag
    marks = marks.withColumn("level", F.when(is_list & (F.col("kind") == "close"), F.col("depth") + 1)
                             .when(is_list, F.col("depth")))
    same = _in_order("name", "level")
    closed = F.lead("kind").over(same) == "close"
    marks = marks.withColumns({"end": F.when(closed, F.lead("pos").over(same)).otherwise(PAGE_END),
                               "_after": F.when(closed, F.lead("_next").over(same))})
    marks = marks.where((is_list & (F.col("kind") == "open")) | (html_link & (F.col("title") != "")))

    def surrounding(rows: DataFrame, asked: Column, told: Column) -> DataFrame:
        """Rows once per asked level with ``outer``, the last told list of that level.

        Lists tell at their own level and may ask at another; the told copies are dropped.
        """
        copies = F.concat(
            F.when(is_list, F.array(F.struct(F.col("level").alias("at"), F.lit(0).alias("asks"))))
            .otherwise(F.array().cast("array<struct<at:int,asks:int>>")),
            F.transform(asked, lambda x: F.struct(x.cast("int").alias("at"), F.lit(1).alias("asks"))))
        both = rows.withColumn("_c", F.explode(copies)).select("*", "_c.*").drop("_c")
        w = Window.partitionBy("page_id", "at").orderBy("pos", "asks")
        seen = F.last(F.when(F.col("asks") == 0, told), ignorenulls=True).over(w)
        return both.withColumn("outer", seen).where("asks = 1").drop("asks")

    # 1: each list asks for the list around it; links pass through
    inner = surrounding(marks, F.when(is_list, F.array(F.col("level") - 1)).otherwise(F.array(F.lit(-1))),
                        F.struct("end", "_next")).drop("at")
    inside = F.col("outer._next.pos").between(F.col("pos"), F.col("end"))
    given = (F.when(~inside, F.col("outer._next.title"))
             .when(F.col("_after.pos") < F.col("outer.end"), F.col("_after.title")))
    lists = inner.withColumn("given", F.when(is_list, given)).drop("outer", "_next", "_after")
    # 2: each link asks for the lists around it; their given titles are its path
    levels = (F.when(is_list, F.array().cast("array<int>"))
              .when(F.col("depth") > 0, F.sequence(F.lit(1), F.col("depth"))).otherwise(F.array(F.lit(0))))
    asked = surrounding(lists, levels, F.struct("given"))
    part = F.when((F.col("at") > 1) & F.col("outer.given").isNotNull(),
                  F.struct("at", F.col("outer.given").alias("given")))
    own = F.when(F.col("hierarchy_level") > 0, F.array("title")).otherwise(F.array().cast("array<string>"))
    return (asked.groupBy("page_id", "pos", "title", "href", F.col("depth").alias("hierarchy_level"))
            .agg(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["given"]).alias("prefix"))
            .select("page_id", "pos", "title", F.concat("prefix", own).alias("path"), "href",
                    page_id_from_href("href").alias("link_page_id"), "hierarchy_level"))


# ---------------------------------------------------------------- pruning

# Prune rules as data: tags, regular expression on id, on class, exact id, exact class, scope.
# A rule hits when all its given conditions hold; scope "first" stops at its first hit.
PRUNE_RULES = [
    {"rule": "P1", "tags": ["ol", "nav", "div"], "id": "breadcrumb|navigation",
     "class": "breadcrumb|navigation"},
    {"rule": "P2", "tags": ["div"], "id": "^main-header$", "first": True},
    {"rule": "P3", "tags": ["h1", "h2", "div"], "id": "title|pagetitle",
     "class": "pagetitle|title-heading"},
    {"rule": "P4", "tags": ["div"], "class": "page-metadata|metadata"},
    {"rule": "P5", "tags": ["div"], "id": "^footer$", "first": True},
]
CONTENT_RULES = [
    {"rule": "P6", "tags": ["nav", "div"], "class": "nav|menu|sidebar"},
]
LEGACY_RULES = [
    {"rule": "P8a", "tags": ["div"], "id": "^breadcrumb-section$", "first": True},
    {"rule": "P8b", "tags": ["h1"], "id": "^title-heading$", "first": True},
    {"rule": "P8c", "tags": ["div"], "class": r"(?:^|\s)page-metadata(?:\s|$)", "first": True},
    {"rule": "P9", "tags": ["style"]},
    {"rule": "P11", "tags": ["a"], "href": "(?i)" + fixed.VENDOR_DOMAIN},
]
# main content, by priority
MAIN_RULES = [
    {"tags": ["div"], "id": "^main-content$", "class": r"(?:^|\s)wiki-content(?:\s|$)"},
    {"tags": ["div"], "class": r"(?:^|\s)wiki-content(?:\s|$)"},
    {"tags": ["div"], "id": "^content$"},
    {"tags": ["div"], "id": "^main$"},
    {"tags": ["body"]},
]


def rule_hit(rule: dict) -> Column:
    """Whether an open tag meets a rule, ignoring its scope."""
    hit = (F.col("kind") == "open") & F.col("name").isin(rule["tags"])
    for name in ("id", "class", "href"):
        if name in rule:
            hit = hit & F.rlike(attr(name), F.lit(rule[name]))
    return _flag(hit)


def _any_rule(tokens: DataFrame, rules: list[dict]) -> tuple[DataFrame, Column]:
    """Tokens with helper columns, and the condition that any rule hits.

    A rule of scope "first" names one tag, so its first hit is found next to the tag depths, in
    the same order: up to a token, the first hit is at the token itself only if none came before.
    """
    firsts = {f"_first{i}": F.min(F.when(rule_hit(r), F.col("pos"))).over(_in_order("name"))
              for i, r in enumerate(rules) if r.get("first")}
    hit = F.lit(False)
    for i, r in enumerate(rules):
        hit = hit | (F.col("pos") == F.col(f"_first{i}") if r.get("first") else rule_hit(r))
    return (tokens.withColumns(firsts) if firsts else tokens), _flag(hit)


def _outside(starts: Column, ends: Column) -> Column:
    """Whether a token lies outside all elements flagged by their open and close tags."""
    delta = starts.cast("int") - ends.cast("int")
    return F.sum(delta).over(_in_order()) + ends.cast("int") == 0


def _remove(rows: DataFrame, keep: Column, blank: bool = False) -> DataFrame:
    """Rows that are kept; with ``blank`` the others stay as rows of kind "gone"."""
    marked = rows.withColumn("_keep", keep)
    if not blank:
        return marked.where("_keep").drop("_keep")
    return marked.withColumns({
        "kind": F.when(F.col("_keep"), F.col("kind")).otherwise("gone"),
        "name": F.when(F.col("_keep"), F.col("name"))}).drop("_keep")


def _match_and_prune(tokens: DataFrame, rules: list[dict], marks: dict[str, Column] | None = None) -> DataFrame:
    """Matched tokens without the subtrees the rules hit: one running sum, no join."""
    helped, hit = _any_rule(tokens, rules)
    matched = match_tags(helped, {"_cut": hit, **(marks or {})})
    return (_remove(matched, _outside(F.col("_cut"), F.col("_cut_end")))
            .drop("_cut", "_cut_end", *[c for c in helped.columns if c.startswith("_first")]))


def html_prune(tokens: DataFrame, rules: list[dict] | None = None) -> DataFrame:
    """Remove whole subtrees by rule."""
    return _match_and_prune(tokens, PRUNE_RULES if rules is None else rules)


def _prune_marked(matched: DataFrame, hit: Column, blank: bool = False) -> DataFrame:
    """Drop the subtrees of open tags found after matching."""
    marked = matched.withColumn("_hit", _flag(hit))
    closing = F.lag("_hit").over(_in_order("name", "depth"))
    marked = marked.withColumn("_ends", _flag(F.when(
        (F.col("kind") == "close") & F.col("partner").isNotNull(), closing)))
    return _remove(marked, _outside(F.col("_hit"), F.col("_ends")), blank).drop("_hit", "_ends")


def _span(*more: Column) -> Column:
    return F.struct(*more, F.col("pos").alias("start"), F.coalesce("partner", F.lit(PAGE_END)).alias("end"))


def _within(span: str) -> Column:
    return F.col("pos").between(F.col(f"{span}.start"), F.col(f"{span}.end"))


def main_content(matched: DataFrame, keep_lost: bool = False) -> DataFrame:
    """Tokens of the main content, the outer element included.

    Pages without one vanish, or leave their first row with a null ``main``.
    """
    rank = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(MAIN_RULES, 1))):
        rank = F.when(rule_hit(rule), i).otherwise(rank)
    best = F.min(F.when(rank.isNotNull(), _span(rank.alias("rank")))).over(_page())
    lost = F.col("main").isNull() & (F.coalesce("pos", F.lit(0)) == 0)
    return matched.withColumn("main", best).where(_within("main") | lost if keep_lost else _within("main"))


def main_content_span(tokens: DataFrame) -> DataFrame:
    """(page_id, rank, start, end): which rule found the main content, and where."""
    return (main_content(html_prune(tokens)).where(F.col("pos") == F.col("main.start"))
            .select("page_id", "main.rank", "main.start",
                    F.nullif(F.col("main.end"), F.lit(PAGE_END)).alias("end")))


def _clean_main(main: DataFrame) -> DataFrame:
    """Navigation inside the main content goes, and its first list if that is a breadcrumb.

    Needs the flags ``_nav`` and ``_nav_end`` of rule P6; the main element itself is exempt.
    """
    starts = _flag(F.col("_nav") & (F.col("pos") > F.col("main.start")))
    ends = F.col("_nav_end") & (F.col("partner") > F.col("main.start"))
    kept = _remove(main, _outside(starts, _flag(ends))).drop("_nav", "_nav_end")
    first_ol = F.min(F.when((F.col("kind") == "open") & (F.col("name") == "ol"), _span())).over(_page())
    kept = kept.withColumn("_ol", first_ol)
    to_index = ((F.col("name") == "a") & (F.col("kind") == "open") & (attr("href") == "index.html")
                & _within("_ol"))
    kept = kept.withColumn("_crumbs", F.max(_flag(to_index)).over(_page()))
    return kept.where(~(F.col("_crumbs") & _flag(_within("_ol")))).drop("_ol", "_crumbs")


# ---------------------------------------------------------------- attributes and blocks

def keep_attrs(tokens: DataFrame) -> DataFrame:
    """Keep only href, src, alt and title attributes."""
    return tokens.withColumn("attrs", F.map_filter(
        "attrs", lambda k, _: k.isin("href", "src", "alt", "title")))


def attachment_url(url) -> Column:
    """An attachment URL cut at ``?`` and wrapped as a template; other URLs unchanged."""
    u = col(url)
    return F.when(u.contains("attachments/"),
                  F.concat(F.lit("{"), F.substring_index(u, "?", 1), F.lit("}"))).otherwise(u)


def rewrite_attachment_urls(tokens: DataFrame) -> DataFrame:
    """Add ``url``: the href or src of a tag, attachments in template form."""
    source = F.when(F.col("name") == "img", attr("src")).when(F.col("name") == "a", attr("href"))
    return (tokens.where(F.col("kind").isin("open", "void") & F.col("name").isin("img", "a"))
            .withColumn("url", attachment_url(source)).where("url is not null"))


def drop_empty_blocks(matched: DataFrame, blank: bool = False) -> DataFrame:
    """Remove ``p`` and ``div`` elements without visible text."""
    has_text = (F.col("kind") == "text") & F.rlike("text", F.lit(r"(?U)\S"))
    upto = F.sum(F.coalesce(has_text, F.lit(False)).cast("int")).over(_in_order())
    counted = matched.withColumn("_upto", upto).withColumn(
        "_end_upto", F.lead("_upto").over(_in_order("name", "depth")))
    empty = ((F.col("kind") == "open") & F.col("name").isin("p", "div")
             & F.col("partner").isNotNull() & (F.col("_upto") == F.col("_end_upto")))
    return _prune_marked(counted, empty, blank).drop("_upto", "_end_upto")


def drop_generator_lines(matched: DataFrame, blank: bool = False) -> DataFrame:
    """Remove the innermost element around a generator line (P10)."""
    level = F.when((F.col("kind") == "open") & F.col("partner").isNotNull(), 1) \
             .when((F.col("kind") == "close") & F.col("partner").isNotNull(), -1).otherwise(0)
    nested = matched.withColumn("_nest", F.sum(level).over(_in_order()))
    opened = F.last(F.when((F.col("kind") == "open") & F.col("partner").isNotNull(), F.col("pos")),
                    ignorenulls=True).over(_in_order("_nest"))
    hit = (F.col("kind") == "text") & F.rlike("text", F.lit(f"(?i){fixed.GENERATOR_LINE}"))
    nested = nested.withColumn("_parent", F.when(hit, opened))
    # the element opened at the same nesting level is the parent; mark its open tag
    parents = F.collect_set("_parent").over(_page())
    nested = nested.withColumn("_parents", parents)
    return _prune_marked(nested, F.array_contains("_parents", F.col("pos")), blank) \
        .drop("_nest", "_parent", "_parents")


# ---------------------------------------------------------------- page level texts

def space_metadata(tokens: DataFrame) -> DataFrame:
    """Key, name, description and creator from the first table; one row per page with any."""
    first = F.min(F.when((F.col("name") == "table") & (F.col("kind") == "open"), _span())).over(_page())
    table = (match_tags(tokens).withColumn("_t", first)
             .where(_within("_t")))
    opens = F.col("kind") == "open"
    is_cell = opens & F.col("name").isin("td", "th")
    rows = (table
            .withColumn("row", F.sum((opens & (F.col("name") == "tr")).cast("int")).over(_in_order()))
            .withColumn("cell", F.sum(F.coalesce(is_cell, F.lit(False)).cast("int")).over(_in_order("row"))))
    piece = F.when(F.col("kind") == "text", strip(F.col("text")))
    cells = (rows.where("row > 0 and cell in (1, 2)").groupBy("page_id", "row")
             .agg(*[F.array_join(F.transform(F.array_sort(F.collect_list(F.when(
                 piece.isNotNull() & (F.col("cell") == n), F.struct("pos", piece.alias("t"))))),
                 lambda r: r["t"]), "").alias(f"c{n}") for n in (1, 2)],
                 F.max("cell").alias("cells"))
             .where("cells = 2"))
    key = F.regexp_replace("c1", ":+$", "")
    return (cells.withColumn("key", key).where(F.col("key").isin(list(fixed.METADATA_KEYS)))
            .groupBy("page_id")
            .agg(*[F.max_by(F.when(F.col("key") == k, F.col("c2")),
                            F.when(F.col("key") == k, F.col("row"))).alias(v)
                   for k, v in fixed.METADATA_KEYS.items()]))


def _ordered_text(run: str = "text") -> Column:
    """Aggregate: text runs in order, decoded, joined and stripped."""
    run = F.when(F.col(run).isNotNull(), F.struct("pos", F.col(run).alias("t")))
    return strip(F.array_join(F.transform(F.array_sort(F.collect_list(run)), lambda r: r["t"]), ""))


def with_breadcrumb_links(matched: DataFrame) -> DataFrame:
    """Add ``crumb``: (item, href) for the tokens of the first link of each item of
    ``ol#breadcrumbs``, null elsewhere."""
    is_open, is_close = F.col("kind") == "open", F.col("kind") == "close"
    in_list = F.min(F.when(is_open & (F.col("name") == "ol") & (attr("id") == "breadcrumbs"), _span())).over(_page())
    rows = matched.withColumn("_ol", in_list)
    inside = _flag(_within("_ol"))
    item, a_open = inside & is_open & (F.col("name") == "li"), inside & is_open & (F.col("name") == "a")
    a_close = inside & is_close & (F.col("name") == "a")
    rows = rows.withColumns({
        "_item": F.sum(_flag(item).cast("int")).over(_in_order()),
        "_as": F.sum(_flag(a_open).cast("int")).over(_in_order()),
        "_closed": F.last(F.when(a_close, F.col("pos")), ignorenulls=True).over(_in_order()),
        "_a": F.last(F.when(a_open, F.struct("pos", F.coalesce(attr("href"), F.lit("")).alias("href"))),
                     ignorenulls=True).over(_in_order())})
    before = F.last(F.when(item, F.col("_as")), ignorenulls=True).over(_in_order())
    first_open = (inside & (F.col("_item") > 0) & (F.col("_as") - F.col("_before") == 1)
                  & (F.col("_a.pos") > F.coalesce("_closed", F.lit(-1))))
    return (rows.withColumn("_before", before)
            .withColumn("crumb", F.when(first_open, F.struct(F.col("_item").alias("item"), F.col("_a.href").alias("href"))))
            .drop("_ol", "_item", "_as", "_closed", "_a", "_before"))


def breadcrumb_lines(run: str = "text") -> Column:
    """Aggregate: numbered lines of the breadcrumb links; all items count, linked or not."""
    pieces = F.array_sort(F.collect_list(F.when(F.col("crumb").isNotNull(), F.struct(
        "crumb.item", "pos", "crumb.href", F.coalesce(F.col(run), F.lit("")).alias("t")))))

    def lines(p):
        def line(i):
            of_item = F.filter(p, lambda x: x["item"] == i)
            title = strip(F.array_join(F.transform(of_item, lambda x: x["t"]), ""))
            return F.concat(i.cast("string"), F.lit(".  ["), title, F.lit("]("), F.get(of_item, F.lit(0))["href"], F.lit(")"))

        return F.array_join(F.transform(F.array_distinct(F.transform(p, lambda x: x["item"])), line), "\n")

    return let(pieces, lines)


def breadcrumb_from_html(tokens: DataFrame) -> DataFrame:
    """(page_id, breadcrumb): numbered lines from ``ol#breadcrumbs``, for pages that have any."""
    return (with_breadcrumb_links(match_tags(tokens)).where("crumb is not null")
            .groupBy("page_id").agg(breadcrumb_lines().alias("breadcrumb")))


def with_title_span(matched: DataFrame) -> DataFrame:
    """Add ``title_span``: ``span#title-text``, else ``<title>``."""
    is_open = F.col("kind") == "open"
    rank = (F.when(is_open & (F.col("name") == "span") & (attr("id") == "title-text"), 1)
            .when(is_open & (F.col("name") == "title"), 2))
    return matched.withColumn("title_span", F.min(F.when(
        rank.isNotNull(), _span(rank.alias("rank")))).over(_page()))


def title_from_page(tokens: DataFrame) -> DataFrame:
    """(page_id, title): title span or tag, organisation prefix removed."""
    inside = _flag(_within("title_span"))
    return (with_title_span(match_tags(tokens)).where(inside).groupBy("page_id")
            .agg(without_title_prefix(_ordered_text()).alias("title")))


# ---------------------------------------------------------------- markdown

# stand for a blank and a line feed that must survive white space clean-up
INDENT, LINE = "\u0001", "\u0002"

# tag → (text at the open tag, text at the close tag); users may pass their own mapping
MARKDOWN_TAGS = {
    **{f"h{n}": ("\n\n" + "#" * n + " ", "\n\n") for n in range(1, 7)},
    "p": ("\n\n", "\n\n"), "div": ("\n\n", "\n\n"), "article": ("\n\n", "\n\n"),
    "section": ("\n\n", "\n\n"), "footer": ("\n\n", "\n\n"), "header": ("\n\n", "\n\n"),
    "ul": ("\n\n", "\n\n"), "ol": ("\n\n", "\n\n"), "table": ("\n\n", "\n\n"),
    "blockquote": ("\n\n> ", "\n\n"), "pre": ("\n\n```\n", "\n```\n\n"),
    "b": ("**", "**"), "strong": ("**", "**"), "i": ("_", "_"), "em": ("_", "_"),
    "code": ("`", "`"), "tt": ("`", "`"), "del": ("~~", "~~"), "s": ("~~", "~~"),
    "li": ("", ""), "tr": ("", "\n"),
}
INLINE_PAIRS = ["b", "strong", "i", "em", "code", "tt", "del", "s"]


def markdown_pieces(matched: DataFrame, templates: bool = True,
                    tags: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Add ``piece``: the markdown each remaining token stands for; heads have none."""
    tags = MARKDOWN_TAGS if tags is None else tags
    kind, name = F.col("kind"), F.col("name")
    is_open, is_close = kind == "open", kind == "close"
    is_list, is_row = name.isin("ul", "ol"), is_open & (name == "tr")
    is_item, is_cell = is_open & (name == "li"), is_open & name.isin("td", "th")

    def depth(cond: Column) -> Column:
        return F.sum(F.when(is_open & cond, 1).when(is_close & cond, -1).otherwise(0)).over(_in_order())

    def count(cond: Column, *keys: str) -> Column:
        return F.sum(_flag(cond).cast("int")).over(_in_order(*keys))

    def at_last(value: str, cond: Column, *keys: str) -> Column:
        return F.last(F.when(cond, F.col(value)), ignorenulls=True).over(_in_order(*keys))

    # positions in lists and tables: running counts, less their value where the list, row or
    # table began; two sort orders serve them all
    rows = matched.withColumns({"_lists": depth(is_list), "_pre": depth(name == "pre"), "_head": depth(name == "head"),
                                "_rows": count(is_row), "_cells": count(is_cell)})
    rows = rows.withColumns({"_cell": F.col("_cells") - at_last("_cells", is_row),
                             "_row": F.col("_rows") - at_last("_rows", is_open & (name == "table"))})
    rows = rows.withColumns({"_items": count(is_item, "_lists"),
                             "_list": at_last("name", is_open & is_list, "_lists")})
    rows = rows.withColumn("_item", F.col("_items") - at_last("_items", is_open & is_list, "_lists"))

    def url(attrs, key):
        return attachment_url(F.col(attrs)[key]) if templates else F.col(attrs)[key]

    def titled(attrs):
        return F.coalesce(F.concat(F.lit(' "'), F.col(attrs)["title"], F.lit('"')), F.lit(""))

    def literals(side: int) -> Column:
        """Text around a tag: one branch per distinct text."""
        out = F.lit(None).cast("string")
        for shown_text in dict.fromkeys(v[side] for v in tags.values()):
            out = F.when(name.isin([t for t, v in tags.items() if v[side] == shown_text]), shown_text).otherwise(out)
        return out

    bullet = F.concat(F.lit("\n"), F.repeat(F.lit(INDENT * 2), F.greatest(F.col("_lists"), F.lit(1)).cast("int")),
                      F.when(F.col("_list") == "ol", F.concat(F.col("_item").cast("string"), F.lit(". ")))
                      .otherwise("* "))
    rule_row = F.concat(F.lit("\n"), F.array_join(F.array_repeat(
        F.lit("---"), F.greatest(F.col("_cell"), F.lit(1)).cast("int")), "|"), F.lit("\n"))
    text = F.col("text")
    image = F.when(F.col("attrs")["src"].isNotNull(), F.concat(
        F.lit("!["), F.coalesce(attr("alt"), F.lit("")), F.lit("]("), url("attrs", "src"), titled("attrs"), F.lit(")")))
    # an inline pair shows only if it is closed and not inside preformatted text
    shown = ~name.isin(INLINE_PAIRS) | (F.col("partner").isNotNull() & (F.col("_pre") == 0))
    opening = (F.when(name == "a", F.when(F.col("attrs")["href"].isNotNull() & F.col("partner").isNotNull(), "["))
               .when(name == "li", bullet)
               .when(name.isin("td", "th"), F.when(F.col("_cell") > 1, "| "))
               .when(shown, literals(0)))
    closing = (F.when(name == "a", F.when(F.col("opener")["href"].isNotNull(), F.concat(
                   F.lit("]("), url("opener", "href"), titled("opener"), F.lit(")"))))
               .when((name == "tr") & (F.col("_row") == 1), rule_row)
               .when(shown, literals(1)))
    piece = (F.when(kind == "text", F.when(F.col("_pre") > 0, F.translate(text, " \n", INDENT + LINE))
                    .otherwise(F.regexp_replace(text, r"(?U)[^\S ]\s*| \s+", " ")))
             .when(name == "br", "  \n").when(name == "hr", "\n\n* * *\n\n").when(name == "img", image)
             .when(is_open, opening).when(is_close, closing))
    return (rows.withColumn("piece", F.when(F.col("_head") == 0, piece))
            .drop("_lists", "_pre", "_head", "_rows", "_cells", "_cell", "_row", "_items", "_list", "_item"))


def joined_pieces() -> Column:
    """Aggregate: the pieces of a page in order, white space tidied."""
    parts = F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("pos", "piece"))))
    tidy = F.array_join(F.transform(parts, lambda p: p["piece"]), "")
    for pattern, new in ((r"\n +(?=[^\n ])", "\n"), (r"(?<! ) \n", "\n"), (r"\n\s*\n", "\n\n")):
        tidy = F.regexp_replace(tidy, pattern, new)
    return F.translate(tidy, INDENT + LINE, " \n")


def converted_pages(pages: DataFrame) -> DataFrame:
    """(page_id, found, markdown): prune, pick the main content, convert, clean.

    ``found`` is false for pages without any content element; they have no markdown.
    """
    tokens = html_tokens(pages, keep_empty=True)
    matched = _match_and_prune(tokens, PRUNE_RULES, {"_nav": rule_hit(CONTENT_RULES[0])})
    pieces = markdown_pieces(_clean_main(main_content(matched, keep_lost=True)))
    found = F.max(F.col("main").isNotNull())
    return (pieces.where(F.col("piece").isNotNull() | (F.col("pos") == F.col("main.start")) | F.col("main").isNull())
            .groupBy("page_id").agg(found.alias("found"), F.when(
                found, strip(clean_markdown(joined_pieces()))).alias("markdown")))


def or_lost(name: Column) -> Column:
    """The markdown of a converted page, or a message with its file name where nothing was found."""
    return F.when(F.col("found"), F.col("markdown")).otherwise(F.concat(F.lit("Could not extract content from "), name))


def html_to_markdown(pages: DataFrame, names: str | None = None) -> DataFrame:
    """(page_id, markdown) of ``converted_pages``; lost pages are named by the ``names`` column, else by id."""
    done, name = converted_pages(pages), F.col("page_id").cast("string")
    if names is not None:
        done, name = done.join(pages.select("page_id", F.col(names).alias("_name")), "page_id", "left"), F.col("_name")
    return done.select("page_id", or_lost(name).alias("markdown"))


def legacy_pages(pages: DataFrame) -> DataFrame:
    """(page_id, title, breadcrumb, markdown) by the legacy chain, in one pass over the tokens.

    Title and breadcrumb are read before rules P8-P11 and the empty blocks cut their tokens.
    """
    helped, hit = _any_rule(html_tokens(pages), LEGACY_RULES)
    rows = with_title_span(with_breadcrumb_links(match_tags(helped, {"_cut": hit})))
    rows = rows.withColumn("title_run", F.when(_within("title_span"), F.col("text"))).withColumn(
        "crumb_run", F.when(F.col("crumb").isNotNull(), F.coalesce("text", F.lit(""))))
    rows = _remove(rows, _outside(F.col("_cut"), F.col("_cut_end")), blank=True)
    rows = drop_generator_lines(drop_empty_blocks(rows, blank=True), blank=True)
    return (markdown_pieces(keep_attrs(rows), templates=False).groupBy("page_id")
            .agg(without_title_prefix(_ordered_text("title_run")).alias("title"),
                 breadcrumb_lines("crumb_run").alias("breadcrumb"), joined_pieces().alias("markdown")))
