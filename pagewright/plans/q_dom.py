"""HTML pages as token tables."""
from pyspark.sql import functions as F

from pagewright.functions import markup
from pagewright.operators import dom
from pagewright.plans.registry import query


def decoded(text: str) -> str:
    """The entities that occur in the given pages."""
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


@query("html_tokens", f"SELECT page_id, pos, kind, name, CASE WHEN kind = 'text' THEN {decoded('token')} END AS text FROM fx_tokens")
def _(fx):
    return dom.html_tokens(fx.table("pages"), attributes=False).select("page_id", "pos", "kind", "name", "text")


@query("html_elements", """
    SELECT page_id, name, "start", "end", CASE WHEN contains(token, 'class="') THEN regexp_extract(token, 'class="([^"]*)"', 1) END AS class FROM fx_elements""")
def _(fx):
    return dom.html_elements(dom.html_tokens(fx.table("pages"))).drop("id")


INDEX = f"(SELECT c_custkey AS page_id, c_name, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
LINKS = f"""(SELECT page_id, 'loose_10000000.html' AS href, 'loose' AS title, '10000000' AS link_page_id, '' AS path, 0 AS hierarchy_level FROM {INDEX}
    UNION ALL SELECT page_id, r_name || '_10000001.html', r_name, '10000001', r_name, 1 FROM {INDEX}
    UNION ALL SELECT page_id, 'n_20000002.html', n_name, '20000002', r_name || '/' || n_name, 2 FROM {INDEX}
    UNION ALL SELECT page_id, 'c_30000003.html', c_name, '30000003', r_name || '/' || n_name || '/' || c_name, 3 FROM {INDEX}
    UNION ALL SELECT page_id, 'b_20000004.html', 'B', '20000004', r_name || '/B', 2 FROM {INDEX}
    UNION ALL SELECT page_id, 'd_30000005.html', 'D', '30000005', r_name || '/B/D', 3 FROM {INDEX})"""


@query("html_links", f"SELECT page_id, href, title, link_page_id FROM {LINKS}")
def _(fx):
    return dom.html_links(dom.html_tokens(fx.index_pages)).select("page_id", "href", "title", "link_page_id")


@query("link_path", f"SELECT page_id, href, title, path, hierarchy_level FROM {LINKS}")
def _(fx):
    return dom.link_paths(dom.html_tokens(fx.index_pages)).select(
        "page_id", "href", "title", F.array_join("path", "/").alias("path"), "hierarchy_level")


@query("ul_depth", r"""
    SELECT page_id, pos, regexp_extract(token, 'href="([^"]*)"', 1) AS href, CAST(d AS INTEGER) AS ul_depth FROM (
      SELECT *, sum(CASE WHEN name = 'ul' AND kind = 'open' THEN 1 WHEN name = 'ul' AND kind = 'close' THEN -1 ELSE 0 END)
        OVER (PARTITION BY page_id ORDER BY pos) AS d FROM fx_tokens) WHERE kind = 'open' AND name = 'a' AND contains(token, 'href=')""")
def _(fx):
    return dom.ul_depth(dom.html_tokens(fx.table("pages")))


BOLD = "'one' || 'two ' || 'bold'"


@query("html_prune", f"""
    SELECT page_id, md5('Information Systems : ' || c_name || 'Menu' || c_name || text || ' ' || {BOLD} || 'ab12' || ' file rel') AS md5 FROM fx_parts""")
def _(fx):
    kept = dom.html_prune(dom.html_tokens(fx.wiki_pages)).where("kind = 'text'")
    runs = F.array_sort(F.collect_list(F.struct("pos", F.col("text").alias("t"))))
    return kept.groupBy("page_id").agg(F.md5(F.array_join(F.transform(runs, lambda r: r["t"]), "")).alias("md5"))


@query("main_content", """
    SELECT page_id, 5 AS rank, min("start") AS "start", arg_min("end", "start") AS "end"
    FROM (SELECT page_id, "start", coalesce("end", -1) AS "end" FROM fx_elements WHERE name = 'body') GROUP BY page_id""")
def _(fx):
    return dom.main_content_span(dom.html_tokens(fx.table("pages"))).withColumn("end", F.coalesce("end", F.lit(-1)))


@query("keep_attrs", """
    SELECT page_id, CAST(6 AS BIGINT) AS tags, 'alt,href,src' AS names FROM fx_parts""")
def _(fx):
    kept = dom.keep_attrs(dom.html_tokens(fx.wiki_pages)).where("size(attrs) > 0")
    return kept.groupBy("page_id").agg(F.count(F.lit(1)).alias("tags"), F.array_join(F.array_sort(F.array_distinct(
        F.flatten(F.collect_set(F.map_keys("attrs"))))), ",").alias("names"))


@query("drop_empty_blocks", r"""
    SELECT page_id, CAST(8 AS BIGINT) AS divs, CAST(2 + CASE WHEN regexp_matches(text, '\S') THEN 1 ELSE 0 END AS BIGINT) AS paragraphs FROM fx_parts""")
def _(fx):
    kept = dom.drop_empty_blocks(dom.match_tags(dom.html_tokens(fx.wiki_pages))).where("kind = 'open'")
    return kept.groupBy("page_id").agg(F.count_if(F.col("name") == "div").alias("divs"),
                                       F.count_if(F.col("name") == "p").alias("paragraphs"))


@query("html_text", r"""
    SELECT page_id, md5(t) AS md5, CAST(length(t) AS INTEGER) AS chars FROM (SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(replace(replace(
      regexp_replace(src, '<[a-zA-Z/!?][^>=]*(?:=\s*(?:"[^"]*"|''[^'']*''|[^\s>]*)[^>=]*)*>', '', 'g'),
      '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS t FROM fx_visible)""")
def _(fx):
    text = markup.visible_text("html")
    return fx.table("pages").select("page_id", F.md5(text).alias("md5"), F.length(text).alias("chars"))


MARKDOWN = r"""('## ' || c_name || chr(10) || chr(10) || trim(regexp_replace(text, '\s+', ' ', 'g')) || chr(10) || chr(10)
    || '  * one' || chr(10) || '  * two **bold**' || chr(10) || chr(10) || 'a| b' || chr(10) || '---|---' || chr(10) || '1| 2' || chr(10) || chr(10)
    || '![pic](' || CASE WHEN p1 = '' THEN '?width=760' ELSE '{' || p1 || '}' END || ') [file](' || CASE WHEN p2 = '' THEN '?v=1' ELSE '{' || p2 || '}' END
    || ') [rel](' || CASE WHEN p1 = '' THEN '../other/' ELSE '{../other/' || p1 || '}' END || ')')"""


@query("html_to_markdown", rf"""
    SELECT page_id, md5(t) AS md5, CAST(length(t) AS INTEGER) AS chars FROM (
      SELECT page_id, regexp_replace({MARKDOWN}, '\|\s*\|', '|', 'g') AS t FROM fx_parts)""")
def _(fx):
    return dom.html_to_markdown(fx.wiki_pages).select(
        "page_id", F.md5("markdown").alias("md5"), F.length("markdown").alias("chars"))


@query("space_metadata", f"""
    SELECT page_id, 'K' || page_id AS space_key, c_name AS space_name, 'of' || n_name AS description, CAST(NULL AS VARCHAR) AS created_by FROM {INDEX}""")
def _(fx):
    return dom.space_metadata(dom.html_tokens(fx.index_pages))


@query("breadcrumb_from_html", """
    SELECT page_id, '1.  [Home](index.html)' || chr(10) || '3.  [' || n_name || '](land.html)' AS breadcrumb FROM fx_parts""")
def _(fx):
    return dom.breadcrumb_from_html(dom.html_tokens(fx.wiki_pages))


@query("title_from_soup", """
    SELECT 'w' || page_id AS id, r_name || ' : ' || c_name AS title FROM fx_parts
    UNION ALL SELECT 'i' || page_id, c_name FROM fx_parts""")
def _(fx):
    spans = dom.title_from_page(dom.html_tokens(fx.wiki_pages)).select(F.concat(F.lit("w"), "page_id").alias("id"), "title")
    bare = fx.wiki_pages.withColumn("html", F.replace("html", F.lit('id="title-text"'), F.lit("")))
    tags = dom.title_from_page(dom.html_tokens(bare)).select(F.concat(F.lit("i"), "page_id").alias("id"), "title")
    return spans.unionByName(tags)


@query("rewrite_attachment_urls", """
    SELECT page_id, unnest(['index.html', 'land.html', 'http://www.atlassian.com', CASE WHEN p1 = '' THEN '?width=760' ELSE '{' || p1 || '}' END,
      CASE WHEN p2 = '' THEN '?v=1' ELSE '{' || p2 || '}' END, CASE WHEN p1 = '' THEN '../other/' ELSE '{../other/' || p1 || '}' END]) AS url FROM fx_parts""")
def _(fx):
    return dom.rewrite_attachment_urls(dom.html_tokens(fx.wiki_pages)).select("page_id", "url")
