"""Markdown cleaning and reading over whole documents."""
from pyspark.sql import functions as F

from pagewright.functions import markdown as md
from pagewright.operators import dom, legacy, status
from pagewright.plans.q_status import raw_files
from pagewright.plans.registry import query


def digest(column):
    return [F.md5(column).alias("md5"), F.length(column).alias("chars")]


DIGEST = "md5(t) AS md5, CAST(length(t) AS INTEGER) AS chars"
NL = "chr(10)"
CRUMB3 = f"(CASE WHEN c_custkey % 5 = 0 THEN 'Land' || {NL} || 'of ' ELSE '' END || n_name)"
CRUMBS = (f"('1. [Home](index.html)' || {NL} || '2. [' || r_name || '](space.html)' || {NL} || '3. [' || {CRUMB3} || '](land.html)')")


def squashed(text: str) -> str:
    return rf"regexp_replace({text}, '\n{{3,}}', chr(10) || chr(10), 'g')"


def stripped(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


# what is left of a page after its breadcrumb lines
AFTER_CRUMBS = f"substring(content, length({CRUMBS}) + 3)"

_kept = f"(CASE WHEN c_custkey % 5 = 0 THEN '3. [' || {CRUMB3} || '](land.html)' || {NL} || {NL} ELSE '' END || {AFTER_CRUMBS})"
_c = squashed(_kept)
_c = rf"regexp_replace({_c}, '(?m)^\s*[*+-]\s*$', '', 'g')"
_c = rf"regexp_replace({_c}, '\|\s*\|', '|', 'g')"
_c = rf"regexp_replace({_c}, '(?m)^Created by.*?modified.*?on.*?$', '', 'g')"
_c = rf"regexp_replace({_c}, '(?m)^Document generated by Confluence.*?$', '', 'g')"


@query("clean_markdown", f"SELECT page_id, {DIGEST} FROM (SELECT page_id, {squashed(_c)} AS t FROM fx_md)")
def _(fx):
    return fx.markdown.select("page_id", *digest(md.clean_markdown("content")))


def post_processed(text: str) -> str:
    """The rewrites without look-ahead: the metadata line of the fixture is known."""
    t = squashed(text)
    t = rf"regexp_replace({t}, '\[\s*\]\([^)]*\)', '', 'g')"
    t = rf"regexp_replace({t}, '(?i)Document generated by Confluence on [^\n]*\n*', '', 'g')"
    t = rf"regexp_replace({t}, '(?i)\[Atlassian\]\([^)]*\)\s*', '', 'g')"
    t = f"replace({t}, 'Created by Ann, last modified by Bob on Jan 01, 2024', '')"
    t = rf"regexp_replace({t}, '(?i)last modified by.*?on [^\n]*\n*', '', 'g')"
    t = rf"regexp_replace({t}, '\n(#{{1,6}}\s)', chr(10) || chr(10) || '\1', 'g')"
    t = rf"regexp_replace({t}, '(?m)[ \t\r\f\v]+$', '', 'g')"
    return stripped(t)


@query("post_process_markdown", f"SELECT page_id, {DIGEST} FROM (SELECT page_id, {post_processed('content')} AS t FROM fx_md)")
def _(fx):
    return fx.markdown.select("page_id", *digest(md.post_process_markdown("content")))


_api = (f"(CASE WHEN c_custkey % 5 = 0 THEN 'of ' || n_name || '](land.html)' || {NL} || {NL} ELSE '' END || '# ' || c_name "
        f"|| substring({AFTER_CRUMBS}, length('# ' || r_name || ' : ' || c_name) + 1))")


@query("clean_content_for_api", f"SELECT page_id, {DIGEST} FROM (SELECT page_id, {stripped(squashed(_api))} AS t FROM fx_md)")
def _(fx):
    return fx.markdown.select("page_id", *digest(md.clean_content_for_api("content")))


@query("parse_breadcrumb", f"""
    SELECT page_id, 'Home|' || r_name || '|' || replace({CRUMB3}, chr(10), ' ') AS titles, 'index.html|space.html|land.html' AS links FROM fx_md""")
def _(fx):
    crumbs = fx.markdown.select("page_id", md.parse_breadcrumb("content").alias("c"))
    return crumbs.select("page_id", F.array_join("c.title", "|").alias("titles"), F.array_join("c.link", "|").alias("links"))


@query("breadcrumb_block", f"SELECT page_id, {CRUMBS} AS block FROM fx_md")
def _(fx):
    return fx.markdown.select("page_id", md.breadcrumb_block("content").alias("block"))


@query("page_path", f"SELECT page_id, replace({CRUMB3}, chr(10), ' ') AS path FROM fx_md")
def _(fx):
    crumbs = fx.markdown.select("page_id", md.parse_breadcrumb("content").alias("c"))
    return crumbs.select("page_id", F.array_join(md.page_path("c"), "/").alias("path"))


@query("title_from_content", "SELECT page_id, c_name AS title FROM fx_md")
def _(fx):
    return fx.markdown.select("page_id", md.title_from_content("content").alias("title"))


@query("title_from_markdown", "SELECT page_id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE r_name || ' : ' || c_name END AS title FROM fx_md")
def _(fx):
    span = F.concat(F.lit('x\n# <span id="title-text"> Information Systems : '), "c_name", F.lit(" </span>\n"), "content")
    text = F.when(F.col("c_custkey") % 2 == 0, span).otherwise(F.col("content"))
    return fx.markdown.select("page_id", md.title_from_markdown(text).alias("title"))


@query("space_name_from_index", """
    SELECT page_id, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'Land of ' || n_name ELSE 'Information Systems' END AS space_name FROM fx_md""")
def _(fx):
    k = F.col("c_custkey") % 3
    table = F.concat(F.lit("Key | K\n---|---\n Name | "), "c_name", F.lit(" | more\nDescription | d\n"), "text")
    flat = F.concat(F.lit("Key | GI ---|--- Name | Land\nof  "), "n_name", F.lit(" Description | d\n"), "text")
    text = F.when(k == 0, table).when(k == 1, flat).otherwise(F.col("text"))
    return fx.markdown.select("page_id", md.space_name_from_index(text).alias("space_name"))


@query("attachment_refs", """
    SELECT page_id, CASE WHEN p1 = '' THEN '' ELSE p1 END || CASE WHEN p2 = '' OR ends_with(p2, '.bin') THEN '' ELSE ',' || p2 END AS refs FROM fx_md""")
def _(fx):
    return fx.markdown.select("page_id", F.array_join(md.attachment_refs("content"), ",").alias("refs"))


# raw documents as markdown files; every 17th cannot be read
RAW = "('# Doc' || chr(10) || chr(10) || text || '   ' || repeat(chr(10), 3))"
CLEAN = f"""(SELECT doc_id, 'd' || doc_id || '.md' AS filename, doc_id % 17 <> 0 AS ok, {post_processed(RAW)} AS t,
    length({RAW}) AS n FROM documents)"""


@query("cleaning_summary", f"""
    SELECT count(*) AS total_files, count(*) FILTER (ok) AS processed, count(*) FILTER (NOT ok) AS errors,
      CAST(sum(CASE WHEN ok THEN n - length(t) END) AS BIGINT) AS size_reduction FROM {CLEAN}""")
def _(fx):
    return status.cleaning_summary(legacy.clean_files(raw_files(fx)))


@query("clean_file", f"""
    SELECT filename, CASE WHEN ok THEN 'Doc' END AS title, CASE WHEN ok THEN '' END AS breadcrumb, CASE WHEN ok THEN md5(t) END AS md5,
      CASE WHEN ok THEN n END AS original_size, CASE WHEN ok THEN length(t) END AS cleaned_size,
      CASE WHEN ok THEN 'markdown' END AS content_type, CASE WHEN NOT ok THEN 'Failed to read file' END AS error FROM {CLEAN}""")
def _(fx):
    return legacy.clean_files(raw_files(fx)).select(
        "filename", "title", "breadcrumb", F.md5("clean_content").alias("md5"), "original_size", "cleaned_size",
        "content_type", "error")


def raw_page_markdown() -> str:
    """Markdown of the given raw pages: they nest nothing but one flat list."""
    t = r"regexp_replace(regexp_extract(src, '(?s)<body>(.*)', 1), '\s+', ' ', 'g')"
    t = rf"""regexp_replace({t}, '<a href="([^"]*)">([^<]*)</a>', '[\2](\1)', 'g')"""
    t = rf"regexp_replace({t}, '</li>|<b>|</body>|</html>|</?nav>', '', 'g')"
    t = f"replace(replace(replace({t}, '<li>', chr(10) || chr(1) || chr(1) || '* '), '<br>', '  ' || chr(10)), '<h1>', chr(10) || chr(10) || '# ')"
    t = rf"regexp_replace({t}, '</h1>|</?ul>|</?p>|</?article>|</?footer>|</?div[^>]*>', chr(10) || chr(10), 'g')"
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"), ("&amp;", "&")):
        t = f"replace({t}, '{entity}', '{char}')"
    t = rf"regexp_replace({t}, '\n +([^\n ])', chr(10) || '\1', 'g')"
    t = rf"regexp_replace({t}, '(^|[^ ]) \n', '\1' || chr(10), 'g')"
    t = rf"regexp_replace({t}, '\n\s*\n', chr(10) || chr(10), 'g')"
    return f"replace({t}, chr(1), ' ')"


@query("html_to_markdown_raw", f"""
    SELECT page_id, {DIGEST} FROM (SELECT page_id, {stripped(squashed(rf"regexp_replace(regexp_replace({raw_page_markdown()}, '(?m)^\s*[*+-]\s*$', '', 'g'), '\|\s*\|', '|', 'g')"))} AS t FROM fx_visible)""")
def _(fx):
    return dom.html_to_markdown(fx.table("pages")).select("page_id", *digest("markdown"))


@query("clean_file_html", rf"""
    SELECT page_id, url AS filename, title, '' AS breadcrumb, md5(t) AS md5, length(html) AS original_size,
      length(t) AS cleaned_size, 'html' AS content_type FROM (
      SELECT page_id, url, html, {post_processed(raw_page_markdown())} AS t,
        trim(replace(replace(regexp_extract(html, '<title>([^<]*)', 1), '&quot;', '"'), '&amp;', '&')) AS title FROM fx_visible)""")
def _(fx):
    pages = fx.table("pages").select("page_id", F.col("url").alias("filename"), F.col("html").alias("raw"))
    return legacy.clean_files(pages).select("page_id", "filename", "title", "breadcrumb", F.md5("clean_content").alias("md5"),
                                            "original_size", "cleaned_size", "content_type")


@query("clean_file_wiki", r"""
    SELECT page_id, r_name || ' : ' || c_name AS title, '1.  [Home](index.html)' || chr(10) || '3.  [' || n_name || '](land.html)' AS breadcrumb,
      'html' AS content_type FROM fx_parts""")
def _(fx):
    pages = fx.wiki_pages.select("page_id", F.concat("page_id", F.lit(".html")).alias("filename"), F.col("html").alias("raw"))
    return legacy.clean_files(pages).select("page_id", "title", "breadcrumb", "content_type")
