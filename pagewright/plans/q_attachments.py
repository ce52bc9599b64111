"""Attachment joins and reference rewriting."""
from pyspark.sql import functions as F

from pagewright.functions import markdown as md
from pagewright.functions import refs
from pagewright.operators import attachments as att
from pagewright.operators import dom, legacy, sync
from pagewright.plans.registry import query

MIME = """CASE l_linenumber % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'application/pdf'
    WHEN 2 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' ELSE 'application/octet-stream' END"""


@query("attachment_inventory", f"SELECT page_id, path, name, size AS size_bytes, {MIME} AS mime_type FROM fx_att")
def _(fx):
    return att.inventory(fx.attachments.select("page_id", "path", "size"))


@query("page_attachments", "SELECT n.page_id, n.title, a.path FROM fx_nodes n JOIN fx_att a ON a.page_id = n.page_id")
def _(fx):
    return att.page_attachments(fx.nodes.select("page_id", "title"), fx.listed.select("page_id", "path"))


@query("page_attachment_refs", "SELECT page_id, p2 || '?v=1' AS path FROM fx_parts WHERE p2 <> ''")
def _(fx):
    return att.attachment_hrefs(dom.html_tokens(fx.wiki_pages)).select("page_id", "path")


@query("page_attachments_union", """
    SELECT page_id, path, 0 AS source FROM fx_att UNION ALL SELECT page_id, p2 || '?v=1', 1 FROM fx_parts WHERE p2 <> ''""")
def _(fx):
    found = att.attachment_hrefs(dom.html_tokens(fx.wiki_pages)).withColumnRenamed("pos", "ord")
    return att.page_attachments_union(fx.listed, found).select("page_id", "path", "source")


REFERENCED = """contains(p1, a.name) OR (contains(p2, a.name) AND NOT ends_with(p2, '.bin'))"""


@query("attachment_referenced", f"""
    SELECT a.page_id, a.path, {REFERENCED} AS referenced_in_content FROM fx_att a JOIN fx_parts p ON p.page_id = a.page_id""")
def _(fx):
    page_refs = fx.markdown.select("page_id", md.attachment_refs("content").alias("refs"))
    return att.with_referenced(fx.attachments, page_refs).select("page_id", "path", "referenced_in_content")


@query("attachments_from_content", f"""
    SELECT a.page_id, a.path, a.name, a.size AS size_bytes, {MIME} AS mime_type, {REFERENCED} AS referenced_in_content
    FROM fx_att a JOIN fx_parts p ON p.page_id = a.page_id""")
def _(fx):
    return legacy.attachments_from_content(fx.markdown, fx.attachments.select("page_id", "path", "size"))


@query("attachment_missing", """
    SELECT page_id, path, 'Attachment file not found: ' || path AS error FROM fx_att WHERE ord % 9 = 0""")
def _(fx):
    return att.missing_files(fx.listed, fx.listed.where("ord % 9 <> 0")).select("page_id", "path", "error")


@query("attachment_details_join", """
    SELECT a.page_id, a.path, d.attachment_id, d.uploaded FROM fx_att a LEFT JOIN fx_det d ON d.page_id = a.page_id AND d.path = a.path""")
def _(fx):
    return att.with_details(fx.listed.select("page_id", "path"),
                            fx.details.select("page_id", "path", "attachment_id", "uploaded"))


@query("pending_attachments", """
    SELECT a.page_id, bool_or(NOT coalesce(d.uploaded, false)) AS pending
    FROM fx_att a LEFT JOIN fx_det d ON d.page_id = a.page_id AND d.path = a.path GROUP BY 1""")
def _(fx):
    return att.pending(fx.listed, fx.details)


@query("attachment_stats", """
    SELECT space_key, count(*) AS total_attachments, count(*) FILTER (uploaded) AS uploaded_attachments,
      count(*) FILTER (NOT uploaded AND upload_failed_at IS NOT NULL) AS failed_attachments,
      count(*) FILTER (NOT uploaded AND upload_failed_at IS NULL) AS skipped_attachments FROM fx_det GROUP BY 1""")
def _(fx):
    return att.statistics(fx.details)


@query("attachment_outcome", """
    SELECT page_id, path, line_status = 'F' AS uploaded, CAST(CASE WHEN line_status = 'F' THEN l_orderkey % 3 ELSE 2 END AS INTEGER) AS retry_count,
      CASE WHEN line_status <> 'F' THEN 'Upload failed after 3 attempts' END AS error,
      CASE WHEN line_status <> 'F' THEN 'HTTP 500 at 2' END AS detailed_error FROM fx_att""")
def _(fx):
    ok = F.col("line_status") == "F"
    last = F.when(ok, F.col("l_orderkey") % 3).otherwise(2).cast("int")
    tries = fx.attachments.select("page_id", "path", ok.alias("ok"), last.alias("last"),
                                  F.explode(F.sequence(F.lit(0), last)).alias("attempt"))
    success = F.col("ok") & (F.col("attempt") == F.col("last"))
    return att.outcomes(tries.withColumn("success", success).withColumn(
        "error", F.when(~success, F.concat(F.lit("HTTP 500 at "), F.col("attempt").cast("string")))))


@query("attachment_payload", f"""
    SELECT page_id, path, '{{"name":"' || name || '","contentType":"' || {MIME} || '","size":' || size
      || ',"documentId":"doc-' || page_id || '"}}' AS request,
      'https://kb/api/attachments.redirect?id=att-' || ord AS api_url FROM fx_att""")
def _(fx):
    files = att.inventory(fx.attachments.select("page_id", "path", "size", "ord")).withColumns({
        "document_id": F.concat(F.lit("doc-"), "page_id"),
        "attachment_id": F.concat(F.lit("att-"), F.col("ord").cast("string"))})
    return sync.attachment_payload(files, "https://kb").withColumn("request", F.to_json("request"))


# ---------------------------------------------------------------- rewriting

STEM1 = "regexp_replace(regexp_extract(p1, '[^/]*$'), '\\.[^.]*$', '')"
STEM2 = "regexp_replace(regexp_extract(p2, '[^/]*$'), '\\.[^.]*$', '')"
NAME1 = "regexp_extract(p1, '[^/]*$')"


# every page; one without attachments refers to a file of a fixed name
FULL = "(SELECT * REPLACE (CASE WHEN p1 = '' THEN 'attachments/none/a file.v2.png' ELSE p1 END AS p1) FROM fx_parts)"


def first_refs(fx):
    none = F.lit("attachments/none/a file.v2.png")
    return fx.page_parts.withColumn("p1", F.when(F.col("p1") == "", none).otherwise(F.col("p1"))).withColumn(
        "name", F.element_at(F.split("p1", "/"), -1)).withColumn(
        "url", F.concat(F.lit("https://kb/a?id="), F.col("page_id")))


def rewritten(column):
    return [F.md5(column).alias("md5"), F.length(column).alias("chars")]


@query("replace_templated_image", f"""
    SELECT page_id, md5(t) AS md5, CAST(length(t) AS INTEGER) AS chars FROM (SELECT page_id,
      text || '![' || c_name || '](https://kb/a?id=' || page_id || ') ![' || {STEM1} || '](https://kb/a?id=' || page_id || ') (' || p1 || ')' AS t
      FROM {FULL})""")
def _(fx):
    before = F.concat("text", F.lit("!["), "c_name", F.lit("]({"), "p1", F.lit("}) ![]({"), "p1", F.lit("}) ("), "p1", F.lit(")"))
    return first_refs(fx).select("page_id", *rewritten(refs.replace_templated_image(before, "p1", "url", "name")))


@query("replace_templated_doc", f"""
    SELECT page_id, md5(t) AS md5, CAST(length(t) AS INTEGER) AS chars FROM (SELECT page_id,
      text || '[x](https://kb/a?id=' || page_id || ') ' || p1 AS t FROM {FULL})""")
def _(fx):
    before = F.concat("text", F.lit("[x]({"), "p1", F.lit("}) "), "p1")
    return first_refs(fx).select("page_id", *rewritten(refs.replace_templated_doc(before, "p1", "url")))


@query("replace_image", f"""
    SELECT page_id, md5(t) AS md5, CAST(length(t) AS INTEGER) AS chars FROM (SELECT page_id,
      text || ' ![a](' || u || ') ![b](' || u || ') ![' || stem || '](' || u || ') see ![' || stem || '](' || u || ')' AS t FROM (
        SELECT page_id, text, {STEM1} AS stem,
          'https://kb/a?id=' || page_id || CASE WHEN c_custkey % 2 = 0 THEN ' " =300x200"' ELSE '' END AS u
        FROM {FULL}))""")
def _(fx):
    title = F.when(F.col("c_custkey") % 2 == 0, ' " =300x200"').otherwise(' "wide"')
    before = F.concat("text", F.lit(" ![a]("), "p1", F.lit(") ![b]("), "p1", title, F.lit(") ![]("), "p1",
                      F.lit(") see ("), "p1", F.lit(")"))
    return first_refs(fx).select("page_id", *rewritten(refs.replace_image(before, "p1", "url", "name")))


@query("replace_doc", f"""
    SELECT page_id, md5(t) AS md5, CAST(length(t) AS INTEGER) AS chars FROM (SELECT page_id,
      text || ' [t](' || u || ') and (' || u || ') and [' || {NAME1} || '](' || u || ')' AS t
      FROM (SELECT *, 'https://kb/a?id=' || page_id AS u FROM {FULL}))""")
def _(fx):
    before = F.concat("text", F.lit(" [t]("), "p1", F.lit(") and ("), "p1", F.lit(") and "), "p1")
    return first_refs(fx).select("page_id", *rewritten(refs.replace_doc(before, "p1", "url", "name")))


REPLACED = f"""(SELECT page_id, text, p1, p2, CASE WHEN u2 IS NULL THEN c1
      WHEN ends_with(p2, '.png') THEN replace(c1, '(' || p2 || ')', '![' || {STEM2} || '](' || u2 || ')')
      ELSE replace(c1, '](' || p2 || ')', '](' || u2 || ')') END AS content
    FROM (SELECT *, CASE WHEN u1 IS NULL THEN content
      WHEN ends_with(p1, '.png') THEN replace(content, '![](' || p1 || ')', '![' || {STEM1} || '](' || u1 || ')')
      ELSE replace(replace(content, '{{' || p1 || '}}', u1), '](' || p1 || ')', '](' || u1 || ')') END AS c1
      FROM (SELECT m.*, d1.api_url AS u1, d2.api_url AS u2 FROM fx_md m
        LEFT JOIN fx_det d1 ON d1.page_id = m.page_id AND d1.path = m.p1
        LEFT JOIN fx_det d2 ON d2.page_id = m.page_id AND d2.path = m.p2)))"""


@query("replace_refs", f"SELECT page_id, md5(content) AS md5, CAST(length(content) AS INTEGER) AS chars FROM {REPLACED}")
def _(fx):
    return att.replace_refs(fx.markdown.select("page_id", "content"), fx.details).select("page_id", *rewritten("content"))


@query("unlinked_attachments", """
    SELECT d.page_id, d.path, d.api_url FROM fx_det d JOIN fx_parts p ON p.page_id = d.page_id
    WHERE uploaded AND d.path <> p1 AND d.path <> p2""")
def _(fx):
    return att.unlinked(fx.markdown.select("page_id", "content"), fx.details).select("page_id", "path", "api_url")


SECTION = """(
    SELECT page_id, part, chunk, md5(text) AS md5 FROM (
      SELECT page_id, 1 AS part, CAST(0 AS BIGINT) AS chunk, chr(10) || chr(10) || '## Original Attachments' || chr(10) || chr(10)
        || CASE WHEN loose > 0 THEN '### Unlinked Attachments' || chr(10) || chr(10) ELSE '' END AS text FROM heads
      UNION ALL SELECT page_id, 3, 0, CASE WHEN loose > 0 THEN chr(10) ELSE '' END || '### Attachment Details' || chr(10) || chr(10) FROM heads
      UNION ALL SELECT page_id, 2, chunk, string_agg(CASE WHEN ends_with(path, '.png') THEN '![' || name || '](' || api_url || ')' || chr(10) || chr(10)
          ELSE '- [' || name || '](' || api_url || ')' || chr(10) END, '' ORDER BY ord)
        FROM (SELECT *, (row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1) // 1000 AS chunk FROM up WHERE NOT linked) GROUP BY page_id, chunk
      UNION ALL SELECT page_id, 4, chunk, string_agg('- **Content Type:** ' || content_type || ' **Original Name:** ' || name
          || ' **Uploaded UUID:** ' || attachment_id || chr(10), '' ORDER BY ord)
        FROM (SELECT *, (row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1) // 1000 AS chunk FROM up) GROUP BY page_id, chunk))"""


def section_sql(extra: str = "") -> str:
    """Chunks of the section; ``up`` and ``heads`` are inlined where they are used."""
    up = ("(SELECT d.*, (d.path = p1 OR d.path = p2) AS linked FROM fx_det d JOIN fx_parts p ON p.page_id = d.page_id WHERE uploaded)")
    heads = f"(SELECT page_id, count(*) FILTER (NOT linked) AS loose FROM {up} GROUP BY 1)"
    body = SECTION.replace("FROM heads", f"FROM {heads}").replace("FROM up", f"FROM {up}")
    return f"SELECT page_id, part, chunk, md5 FROM {body}{extra}"


@query("attachments_section", section_sql())
def _(fx):
    return att.section_chunks(fx.markdown.select("page_id", "content"), fx.details).select(
        "page_id", "part", "chunk", F.md5("text").alias("md5"))


@query("prepare_content", section_sql(f" UNION ALL SELECT page_id, 0, 0, md5(content) FROM {REPLACED}"))
def _(fx):
    return att.prepare_content(fx.markdown.select("page_id", "content"), fx.listed, fx.details).select(
        "page_id", "part", "chunk", F.md5("text").alias("md5"))
