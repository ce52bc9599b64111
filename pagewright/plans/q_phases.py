"""Whole phases over the derived exports."""
from pyspark.sql import functions as F

from pagewright import phases
from pagewright.operators import legacy, sync
from pagewright.plans.q_attachments import MIME
from pagewright.plans.q_dom import INDEX, MARKDOWN
from pagewright.plans.q_sync import ACTION, NORMAL, STUBBED
from pagewright.plans.registry import label, query
from pagewright.session import stage_small


@query("extract_zips", """
    SELECT 'zips/page-' || page_id || '.html.zip' AS zip_file, 'page-' || page_id AS folder_name, page_id % 10 <> 9 AS success,
      CAST(CASE WHEN page_id % 10 = 9 THEN 0 ELSE 2 END AS BIGINT) AS files_extracted, CAST(0 AS BIGINT) AS files_blocked,
      CASE WHEN page_id % 10 = 9 THEN 'Invalid or corrupted zip file' END AS error FROM pages""")
def _(fx):
    return phases.extract_zips(fx.page_archives)[0]


ITEMS = f"""(SELECT page_id, r_name AS path, 'collection' AS type, '10000001' AS id FROM {INDEX}
    UNION ALL SELECT page_id, r_name || '/' || n_name, 'collection', '20000002' FROM {INDEX}
    UNION ALL SELECT page_id, r_name || '/' || n_name || '/' || c_name, 'page', '30000003' FROM {INDEX}
    UNION ALL SELECT page_id, r_name || '/B', 'collection', '20000004' FROM {INDEX}
    UNION ALL SELECT page_id, r_name || '/B/D', 'page', '30000005' FROM {INDEX})"""


def processed(fx):
    """Each customer's index page is a space; only two of its page files exist."""
    index = fx.index_pages.select("page_id", F.lit("Export-1").alias("export"), F.concat(
        F.lit("F"), F.col("page_id").cast("string")).alias("folder"), "html")
    found = index.select("page_id", F.explode(F.array(F.lit("c_30000003.html"), F.lit("b_20000004.html"))).alias("href"))
    return phases.process_input(index, found)


@query("process_input", f"""
    SELECT 'k' || page_id AS space_key, path, type, id AS page_id,
      CASE id WHEN '30000003' THEN 'c_30000003.html' WHEN '20000004' THEN 'b_20000004.html' END AS html_page FROM {ITEMS}""")
def _(fx):
    return processed(fx)[1].select("space_key", label().alias("path"), "type", "page_id", "html_page")


@query("process_input_spaces", f"""
    SELECT 'k' || page_id AS space_key, c_name AS space_name, 'of' || n_name AS description, 'input/Export-1/F' || page_id AS local_folder,
      CAST(6 AS BIGINT) AS total_links_found, CAST(2 AS BIGINT) AS total_pages, CAST(3 AS BIGINT) AS total_navigation_nodes, 3 AS max_depth,
      CAST(6 AS BIGINT) AS unique_paths, CAST(1 AS BIGINT) AS root_items, CAST(5 AS BIGINT) AS total_items FROM {INDEX}""")
def _(fx):
    return processed(fx)[0].drop("export", "folder")


@query("extract_content", rf"""
    SELECT i.href, md5(CASE WHEN i.pos % 7 = 0 THEN '# ' || title || chr(10) || chr(10) || 'This is a collection page.'
      WHEN p.page_id IS NULL THEN '# ' || title || chr(10) || chr(10) || 'Content not found.' ELSE md END) AS md5
    FROM fx_items i LEFT JOIN (SELECT page_id, regexp_replace({MARKDOWN}, '\|\s*\|', '|', 'g') AS md FROM fx_parts WHERE c_custkey % 4 <> 0) p
      ON p.page_id = i.page_id""")
def _(fx):
    items = fx.items.withColumn("html_page", F.when(F.col("pos") % 7 != 0, F.col("href")))
    pages = (fx.wiki_pages.where("cast(page_id as long) % 4 <> 0").join(fx.items.select("page_id", "space_key", "href"), "page_id")
             .select("space_key", "href", "html"))
    return phases.extract_content(items, pages).select("href", F.md5("md_content").alias("md5"))


@query("upload_plan", rf"""
    SELECT space_key, array_to_string(path, '/') AS path, action, depth - 1 AS wave, up AS parent_uuid, waits AS waits_for_parent, CASE WHEN action = 'create' AND NOT waits THEN
      '{{"title":"' || title || '","text":"' || text || '","collectionId":"' || collection_id || '","publish":true'
      || CASE WHEN up IS NULL THEN '' ELSE ',"parentDocumentId":"' || up || '"' END || '}}' END AS request
    FROM (SELECT i.*, {NORMAL} AS action, {STUBBED} AS text, CASE WHEN depth > 2 THEN p.up END AS up,
        depth > 2 AND {NORMAL} = 'create' AND coalesce(p.made, false) AS waits FROM {ACTION} i
      LEFT JOIN (SELECT DISTINCT page_id FROM fx_att) a ON a.page_id = i.page_id
      LEFT JOIN (SELECT space_key AS sk, path AS pp, {NORMAL} = 'create' AS made,
        CASE WHEN {NORMAL} <> 'create' THEN page_uuid END AS up FROM {ACTION} x) p ON p.sk = i.space_key AND p.pp = i.parent_path)""")
def _(fx):
    return phases.upload_plan(fx.items, fx.documents, fx.spaces, fx.listed).select(
        "space_key", label().alias("path"), "action", "wave", "parent_uuid", "waits_for_parent", "request")


# the space of region 4 has no collection yet; every second document to be created was created in this run
MADE = f"(SELECT *, {NORMAL} AS action, {NORMAL} = 'create' AND pos % 2 = 0 AS fresh FROM {ACTION} WHERE collection_id <> 'col-4')"
UP = "CASE WHEN x.fresh THEN 'new-' || x.pos ELSE x.page_uuid END"


@query("upload_requests", rf"""
    SELECT s.space_key, CAST(NULL AS VARCHAR) AS path, 0 AS wave, 0 AS step, 'collection' AS kind, CAST(NULL AS VARCHAR) AS key, s.space_name AS name
    FROM fx_spaces s WHERE collection_id = 'col-4'
    UNION ALL SELECT space_key, array_to_string(i.path, '/'), depth - 1, 1, 'document', NULL, title FROM {MADE} i
      LEFT JOIN (SELECT space_key AS sk, path AS pp, action = 'create' AND NOT fresh AS open FROM {MADE} x) p ON p.sk = i.space_key AND p.pp = i.parent_path
      WHERE i.action = 'create' AND NOT fresh AND NOT (depth > 2 AND coalesce(p.open, false))
    UNION ALL SELECT x.space_key, array_to_string(x.path, '/'), depth - 1, 2, 'attachment', a.path, {MIME} || ' ' || {UP}
      FROM {MADE} x JOIN fx_att a ON a.page_id = x.page_id
      WHERE (x.fresh OR action = 'skip' AND ex) AND NOT EXISTS (SELECT 1 FROM fx_det d WHERE d.path = a.path AND d.uploaded)
    UNION ALL SELECT x.space_key, array_to_string(x.path, '/'), depth - 1, 3, 'update', NULL, {UP} FROM {MADE} x WHERE fresh
      AND page_id IN (SELECT page_id FROM fx_att) AND page_id NOT IN (SELECT page_id FROM fx_att WHERE quantity <= 5)""")
def _(fx):
    spaces = fx.spaces.withColumn("collection_id", F.when(F.col("collection_id") != "col-4", F.col("collection_id")))
    items = stage_small(fx.items, "items")
    fx.attachments = stage_small(fx.attachments, "attachments")  # listed, files and details come from it
    new = sync.sync_action(items, fx.documents, fx.spaces).where("action = 'create' AND pos % 2 = 0").select(
        "space_key", "path", F.concat(F.lit("new-"), "pos").alias("page_uuid"))
    got = phases.upload_requests(items, fx.documents, spaces, fx.listed, fx.attachments, fx.details,
                                 fx.markdown.select("page_id", "content"), new)
    field = lambda name: F.get_json_object("request", f"$.{name}")
    name = (F.when(F.col("kind") == "collection", field("name")).when(F.col("kind") == "document", field("title"))
            .when(F.col("kind") == "update", field("id")).otherwise(F.concat_ws(" ", field("contentType"), field("documentId"))))
    return got.select("space_key", label().alias("path"), "wave", "step", "kind", "key", name.alias("name"))


@query("detected_space_name", """
    SELECT coalesce((SELECT c_name FROM customer WHERE c_custkey = 0), 'Information Systems') AS space_name""")
def _(fx):
    pages = fx.table("customer").select(
        F.concat(F.lpad(F.col("c_custkey").cast("string"), 12, "0"), F.lit("/"), F.when(
            F.col("c_custkey") % 2 == 0, "index.html").otherwise("page.html")).alias("file_path"),
        F.concat(F.lit("Key | k\nName | "), "c_name").alias("content"))
    return legacy.detected_space_name(pages)
