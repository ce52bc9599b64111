"""Predicates, names and scalar functions over whole tables."""
from pyspark.sql import functions as F

from pagewright.functions import fixed, text
from pagewright.operators import archives, attachments, status
from pagewright.plans.registry import label, query

@query("zip_folder_name", """
    SELECT zip_file, 'Export-' || split_part(split_part(zip_file, 'export-', 2), '.', 1) AS folder_name
    FROM (SELECT DISTINCT zip_file FROM fx_zip)""")
def _(fx):
    return fx.zip_members.select("zip_file").distinct().withColumn(
        "folder_name", text.zip_folder_name("zip_file"))


@query("zip_member_guard", "SELECT zip_file, member, file_size, reason FROM fx_guard")
def _(fx):
    return fx.zip_members.withColumn("reason", text.zip_member_guard("member", "file_size"))


@query("zip_archive_guard", "SELECT zip_file, files, total_size, error FROM fx_zips")
def _(fx):
    return archives.archive_guard(fx.zip_members, max_files=20)


@query("extension_filter", """
    SELECT zip_file, member FROM fx_zip
    WHERE lower(right(member, 4)) IN ('.png', '.pdf', '.bin') OR lower(right(member, 5)) = '.docx'""")
def _(fx):
    return archives.extension_filter(fx.zip_members, "member", include="bin, .csv").select("zip_file", "member")


@query("detect_content_type", """
    SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN contains(lower(text), '<!doctype html') OR contains(lower(text), '<html')
      OR contains(lower(text), '<head') OR contains(lower(text), '<body') THEN 'html' ELSE 'markdown' END AS content_type FROM documents
    UNION ALL SELECT url, CASE WHEN contains(lower(html), '<html') OR contains(lower(html), '<!doctype html')
      OR contains(lower(html), '<head') OR contains(lower(html), '<body') THEN 'html' ELSE 'markdown' END FROM pages""")
def _(fx):
    docs = fx.table("documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    pages = fx.table("pages").select(F.col("url").alias("id"), F.col("html").alias("text"))
    return docs.unionByName(pages).select("id", text.detect_content_type("text").alias("content_type"))


@query("page_id_from_href", """
    SELECT href, pos, CASE WHEN pos % 2 = 0 THEN CAST(pos AS VARCHAR) END AS page_id
    FROM (SELECT pos, CASE WHEN pos % 2 = 0 THEN href ELSE href || '?x=' || pos || '#a' END AS href FROM fx_links)""")
def _(fx):
    noisy = F.when(F.col("pos") % 2 == 0, F.col("href")).otherwise(
        F.concat("href", F.lit("?x="), F.col("pos").cast("string"), F.lit("#a")))
    return fx.links.select("pos", noisy.alias("href")).withColumn("page_id", text.page_id_from_href("href"))


@query("page_id_from_name", "SELECT pos, href || '_12345678' AS name, CAST(pos AS VARCHAR) AS page_id FROM fx_links")
def _(fx):
    return fx.links.select("pos", F.concat("href", F.lit("_12345678")).alias("name")).withColumn(
        "page_id", text.page_id_from_name("name"))


@query("page_id_from_filename", """
    SELECT pos, CASE pos % 3 WHEN 0 THEN CAST(pos AS VARCHAR) WHEN 1 THEN CAST(pos AS VARCHAR) ELSE '' END AS page_id FROM fx_links""")
def _(fx):
    name = (F.when(F.col("pos") % 3 == 0, F.concat(F.lit("clean_"), "href"))
            .when(F.col("pos") % 3 == 1, F.concat(F.col("pos").cast("string"), F.lit(".md")))
            .otherwise(F.concat(F.lit("x"), F.col("pos").cast("string"), F.lit(".html"))))
    return fx.links.select("pos", text.page_id_from_filename(name).alias("page_id"))


TITLE_SQL = r"""
    SELECT page_id, CASE WHEN length(t) > 3 THEN t WHEN length(h) > 3 THEN h ELSE fallback END AS title FROM (
      SELECT page_id,
        trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS t,
        trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS h,
        'Untitled Document' AS fallback FROM pages)"""


@query("title_from_html", TITLE_SQL)
def _(fx):
    return fx.table("pages").select("page_id", text.title_from_html("html", F.lit("")).alias("title"))


@query("item_type", """
    SELECT n.space_key, array_to_string(n.path, '/') AS path, coalesce(k.children, 0) AS children,
      CASE WHEN k.children IS NULL THEN 'page' ELSE 'collection' END AS item_type
    FROM fx_nodes n LEFT JOIN (SELECT space_key, parent_path, count(*) AS children FROM fx_nodes GROUP BY ALL) k
      ON k.space_key = n.space_key AND k.parent_path = n.path""")
def _(fx):
    kids = (fx.nodes.groupBy("space_key", F.col("parent_path").alias("path"))
            .agg(F.count(F.lit(1)).alias("children")))
    return (fx.nodes.join(kids, ["space_key", "path"], "left")
            .select("space_key", label().alias("path"), F.coalesce("children", F.lit(0).cast("long")).alias("children"))
            .withColumn("item_type", text.item_type("children")))


@query("space_key_fallback", """
    SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'folder' || s_suppkey ELSE lower(s_name) END AS space_key FROM supplier""")
def _(fx):
    key = F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name"))
    return fx.table("supplier").select("s_suppkey", text.space_key_or_default(
        key, F.concat(F.lit("Folder"), F.col("s_suppkey").cast("string"))).alias("space_key"))


@query("default_content", """
    SELECT pos, CASE WHEN pos % 5 = 0 THEN '# ' || title || chr(10) || chr(10) || 'This is a collection page.'
      WHEN pos % 7 = 0 THEN '# ' || title || chr(10) || chr(10) || 'Content not found.'
      ELSE 'converted ' || title END AS content FROM fx_links""")
def _(fx):
    return fx.links.select("pos", text.default_content(
        "title", F.when(F.col("pos") % 5 != 0, F.col("href")), F.col("pos") % 7 != 0,
        F.concat(F.lit("converted "), "title")).alias("content"))


@query("is_image", """
    SELECT path, starts_with(content_type, 'image/') OR ends_with(path, '.png') AS is_image FROM fx_det""")
def _(fx):
    return fx.details.select("path", text.is_image("content_type", "path").alias("is_image"))


@query("response_class", """
    SELECT event_id, CASE status WHEN 200 THEN 'ok' WHEN 429 THEN 'limited' WHEN 500 THEN 'server_error' WHEN 404 THEN 'client_error' END AS class,
      CASE status WHEN 200 THEN NULL
        WHEN 429 THEN 'Rate limited - retry after ' || coalesce(CAST(trunc(wait) AS INTEGER), 60) || ' seconds'
        WHEN 500 THEN 'k is ' || json_extract_string(props, '$.k') ELSE 'HTTP 404' END AS error
    FROM (SELECT event_id, props, CASE event_type WHEN 'signup' THEN 200 WHEN 'purchase' THEN 500 WHEN 'view' THEN 404 ELSE 429 END AS status,
            CASE WHEN event_id % 2 = 0 THEN value END AS wait FROM events)""")
def _(fx):
    kind = F.col("event_type")
    e = fx.table("events").withColumns({
        "status": F.when(kind == "signup", 200).when(kind == "purchase", 500).when(kind == "view", 404).otherwise(429),
        "body": F.when(kind == "purchase", F.to_json(F.struct(F.concat(
            F.lit("k is "), F.get_json_object("props", "$.k")).alias("message")))).otherwise("{}"),
        "wait": F.when(F.col("event_id") % 2 == 0, F.col("value"))})
    return e.select("event_id", text.response_class("status").alias("class"),
                    text.response_error("status", "body", "wait").alias("error"))


@query("mime_type", """
    SELECT path, CASE l_linenumber % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'application/pdf'
      WHEN 2 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
      ELSE 'application/octet-stream' END AS mime_type FROM fx_att""")
def _(fx):
    return text.with_mime_type(fx.attachments.select("path", "name"), "name").select("path", "mime_type")


@query("safe_filename", "SELECT doc_id, regexp_replace(text, '[^a-zA-Z0-9_-]', '', 'g') AS name FROM documents")
def _(fx):
    return fx.table("documents").select("doc_id", text.safe_filename("text").alias("name"))


# ---------------------------------------------------------------- sets and scalars

@query("set_union_dedupe", """
    SELECT page_id, path, min(src) AS source FROM (
      SELECT page_id, path, 0 AS src FROM fx_att WHERE quantity > 20
      UNION ALL SELECT page_id, path, 1 FROM fx_att WHERE quantity < 30) GROUP BY page_id, path""")
def _(fx):
    a = fx.attachments
    return attachments.page_attachments_union(a.where("quantity > 20"), a.where("quantity < 30")) \
        .select("page_id", "path", "source")


@query("set_distinct", "SELECT DISTINCT space_key, array_to_string(path, '/') AS path FROM fx_links")
def _(fx):
    return fx.links.select("space_key", "path").distinct().withColumn("path", label())


@query("scalar_string", r"""
    SELECT doc_id, lower(trim(text, chr(10) || chr(9) || chr(13) || ' ')) AS lowered,
      replace(lang, 'e', '-') AS replaced, starts_with(source, 'w') AS has_prefix, ends_with(source, 'b') AS has_suffix,
      contains(text, 'the') AS has_part, upper(left(lang, 1)) || lower(substring(lang, 2)) AS capitalised,
      array_to_string(string_split(source, '-'), '+') AS rejoined, substring(source, 1, 30) AS sliced FROM documents""")
def _(fx):
    return fx.table("documents").select(
        "doc_id", F.lower(text.strip("text")).alias("lowered"), F.replace("lang", F.lit("e"), F.lit("-")).alias("replaced"),
        F.startswith("source", F.lit("w")).alias("has_prefix"), F.endswith("source", F.lit("b")).alias("has_suffix"),
        F.contains("text", F.lit("the")).alias("has_part"), F.initcap("lang").alias("capitalised"),
        F.array_join(F.split("source", "-"), "+").alias("rejoined"), F.substring("source", 1, 30).alias("sliced"))


@query("scalar_regex", r"""
    SELECT page_id, CAST(len(regexp_extract_all(html, '<a [^>]*href="([^"]*)"')) AS INTEGER) AS links,
      regexp_extract(html, '<title>([^<]*)', 1) AS title, regexp_matches(html, '(?i)<!DOCTYPE html|<html|<head|<body') AS is_html,
      regexp_replace(url, '[^a-zA-Z0-9_-]', '', 'g') AS safe,
      CAST(len(regexp_extract_all(html, 'src=["'']([^"'']+)["'']')) AS INTEGER) AS sources FROM pages""")
def _(fx):
    return fx.table("pages").select(
        "page_id", F.size(F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), F.lit(1))).alias("links"),
        F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"),
        F.rlike("html", F.lit("(?i)" + fixed.HTML_MARKERS)).alias("is_html"),
        text.safe_filename("url").alias("safe"),
        F.size(F.regexp_extract_all("html", F.lit(fixed.SRC_REF), F.lit(1))).alias("sources"))


@query("scalar_array", """
    SELECT pos, array_to_string(path[1:len(path) - 1], '/') AS parent, array_to_string(list_reverse(path), '/') AS reversed,
      array_to_string(path[3:], '/') AS tail, array_to_string(list_append(path, title), '/') AS appended,
      list_contains(path, 'ASIA') AS in_asia FROM fx_links""")
def _(fx):
    from pagewright.operators.tree import parent_of

    return fx.links.select(
        "pos", F.array_join(parent_of(), "/").alias("parent"), F.array_join(F.reverse("path"), "/").alias("reversed"),
        F.array_join(F.slice("path", 3, F.greatest(F.size("path"), F.lit(1))), "/").alias("tail"),
        F.array_join(F.array_append("path", F.col("title")), "/").alias("appended"),
        F.array_contains("path", "ASIA").alias("in_asia"))


@query("scalar_map", """
    SELECT path, CAST(size AS VARCHAR) AS size, 2 AS kept, 'name,size' AS keys FROM fx_det""")
def _(fx):
    detail = F.map_from_entries(F.array(*[F.struct(F.lit(k), F.col(k).cast("string")) for k in
                                          ("name", "size", "attachment_id")]))
    kept = F.map_filter(detail, lambda k, _: k.isin("name", "size"))
    return fx.details.select("path", kept["size"].alias("size"), F.size(kept).alias("kept"),
                             F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("keys"))


@query("scalar_json", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      '{"event":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS dumped FROM events""")
def _(fx):
    k = F.from_json("props", "k long")["k"]
    return fx.table("events").select("event_id", k.alias("k"), F.to_json(F.struct(
        F.col("event_type").alias("event"), k.alias("k"))).alias("dumped"))


@query("scalar_date", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events""")
def _(fx):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return fx.table("events").select("event_id", iso.alias("iso"), F.replace(
        F.substring(iso, 1, 19), F.lit("T"), F.lit(" ")).alias("shown"))


@query("scalar_math", """
    SELECT event_id, least(value, 60.0) AS low, greatest(value, 2.0) AS high,
      CAST(pow(2, event_id % 6) AS DOUBLE) AS power, round(value / 1000.0 * 100, 4) AS share FROM events""")
def _(fx):
    v = F.col("value")
    return fx.table("events").select(
        "event_id", F.least(v, F.lit(60.0)).alias("low"), F.greatest(v, F.lit(2.0)).alias("high"),
        F.pow(F.lit(2.0), F.col("event_id") % 6).alias("power"),
        F.round(status.percent(v, F.lit(1000.0)), 4).alias("share"))
