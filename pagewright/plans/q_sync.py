"""Synchronisation plans over the derived items and snapshots."""
from pyspark.sql import functions as F

from pagewright.operators import status, sync
from pagewright.plans.registry import label, query

ITEM = "array_to_string(i.path, '/') AS path"


@query("list_collections", "SELECT id, name, document_count FROM fx_cols ORDER BY updated_at DESC, id LIMIT 25 OFFSET 2")
def _(fx):
    return sync.newest_first(fx.collections, 25, 2).select("id", "name", "document_count")


@query("list_documents", """
    SELECT id, title, md5(text) AS md5 FROM fx_docs WHERE collection_id = 'col-1' ORDER BY updated_at DESC, id LIMIT 25 OFFSET 5""")
def _(fx):
    return sync.list_documents(fx.documents, "col-1", 25, 5).select("id", "title", F.md5("text").alias("md5"))


@query("get_document", "SELECT id, title FROM fx_docs WHERE id IN (SELECT page_uuid FROM fx_items)")
def _(fx):
    return sync.get_by_id(fx.documents, fx.items.select(F.col("page_uuid").alias("id"))).select("id", "title")


@query("get_collection", "SELECT id, name, document_count FROM fx_cols WHERE id IN (SELECT stored_id FROM fx_sspaces)")
def _(fx):
    return sync.get_by_id(fx.collections, fx.supplier_spaces.select(F.col("stored_id").alias("id"))) \
        .select("id", "name", "document_count")


@query("search_documents", """
    SELECT id, title, CAST(contains(t, 'body')::INT + contains(t, 'changed')::INT + contains(t, '00000001')::INT AS INTEGER) AS score
    FROM (SELECT *, lower(title || ' ' || text) AS t FROM fx_docs) WHERE score > 0 ORDER BY score DESC, id LIMIT 25""")
def _(fx):
    return sync.search_documents(fx.documents, "Body changed 00000001").select("id", "title", "score")


@query("collection_ambiguity", """
    SELECT name, id, count(*) OVER (PARTITION BY name) AS matches, coalesce(CAST(document_count AS VARCHAR), 'unknown') AS documents,
      row_number() OVER (PARTITION BY name ORDER BY updated_at DESC, id) AS choice
    FROM fx_cols QUALIFY count(*) OVER (PARTITION BY name) > 1""")
def _(fx):
    return sync.ambiguous_collections(fx.collections).select(
        "name", "id", "matches", "documents", F.col("choice").cast("long").alias("choice"))


@query("collection_match", """
    SELECT space_key, decision, CASE decision WHEN 'stored' THEN stored_id WHEN 'found' THEN only_id WHEN 'chosen' THEN picked END AS collection_id
    FROM (SELECT s.space_key, s.stored_id, m.only_id, ch.id AS picked,
        CASE WHEN st.name = s.space_name THEN 'stored' WHEN m.n IS NULL THEN 'create' WHEN m.n = 1 THEN 'found'
             WHEN ch.id IS NOT NULL THEN 'chosen' ELSE 'ambiguous' END AS decision
      FROM fx_sspaces s LEFT JOIN fx_cols st ON st.id = s.stored_id
      LEFT JOIN (SELECT name, count(*) AS n, min(id) AS only_id FROM fx_cols GROUP BY 1) m ON m.name = s.space_name
      LEFT JOIN (SELECT name, id, row_number() OVER (PARTITION BY name ORDER BY updated_at DESC, id) AS k FROM fx_cols) ch
        ON ch.name = s.space_name AND ch.k = s.choice AND m.n > 1)""")
def _(fx):
    return sync.match_collections(fx.supplier_spaces, fx.collections).select("space_key", "decision", "collection_id")


EXISTS = "(i.page_uuid IN (SELECT id FROM fx_docs) AND i.page_uuid <> s.collection_id)"
ACTION = f"""(SELECT i.*, s.collection_id, coalesce({EXISTS}, false) AS ex FROM fx_items i JOIN fx_spaces s ON s.space_key = i.space_key)"""
NORMAL = """CASE WHEN depth = 1 THEN 'space_root' WHEN created AND (ex OR page_uuid IS NULL) THEN 'skip' ELSE 'create' END"""


@query("document_exists", f"SELECT space_key, array_to_string(path, '/') AS path, page_uuid, ex AS exists_remotely FROM {ACTION}")
def _(fx):
    return sync.with_existence(fx.items, fx.documents, fx.spaces).select(
        "space_key", label().alias("path"), "page_uuid", "exists_remotely")


@query("sync_action", f"""
    SELECT space_key, array_to_string(path, '/') AS path, 'normal' AS mode, {NORMAL} AS action FROM {ACTION}
    UNION ALL SELECT space_key, array_to_string(path, '/'), 'force',
      CASE WHEN depth = 1 THEN 'space_root' WHEN created AND ex THEN 'update' ELSE 'create' END FROM {ACTION}""")
def _(fx):
    def mode(name, force):
        return sync.sync_action(fx.items, fx.documents, fx.spaces, force).select(
            "space_key", label().alias("path"), F.lit(name).alias("mode"), "action")

    return mode("normal", False).unionByName(mode("force", True))


@query("sync_waves", "SELECT space_key, array_to_string(path, '/') AS path, depth - 1 AS wave, pos FROM fx_items")
def _(fx):
    return sync.sync_waves(fx.items).select("space_key", label().alias("path"), "wave", "pos")


@query("sync_subtree_skip", """
    SELECT space_key, array_to_string(path, '/') AS path FROM fx_items i
    WHERE depth < 3 OR NOT EXISTS (SELECT 1 FROM fx_items f WHERE f.depth = 2 AND f.pos % 4 = 0 AND f.space_key = i.space_key AND f.path = i.path[1:2])""")
def _(fx):
    failed = fx.items.where("depth = 2 and pos % 4 = 0")
    return sync.attempted_items(fx.items, failed).select("space_key", label().alias("path"))


@query("parent_uuid", """
    SELECT i.space_key, array_to_string(i.path, '/') AS path, CASE WHEN i.depth > 2 THEN p.page_uuid END AS parent_uuid
    FROM fx_items i LEFT JOIN fx_items p ON p.space_key = i.space_key AND p.path = i.parent_path""")
def _(fx):
    return sync.with_parent_uuid(fx.items).select("space_key", label().alias("path"), "parent_uuid")


# ---------------------------------------------------------------- payloads

@query("collection_payload", """
    SELECT s.space_key, '{"name":"' || s.space_name || '","description":"' || CASE WHEN i.md_content = '' THEN 'Imported from Confluence space: ' || s.space_key
      ELSE replace(i.md_content, chr(10), '\\n') END || '","color":"#4E5C6E","icon":"collection"}' AS request
    FROM fx_spaces s JOIN fx_items i ON i.space_key = s.space_key AND i.depth = 1""")
def _(fx):
    return sync.collection_payload(fx.spaces, fx.items).withColumn("request", F.to_json("request"))


STUBBED = r"""CASE WHEN a.page_id IS NOT NULL THEN '# ' || title || '\n\n*Loading content with attachments...*'
    WHEN md_content <> '' THEN replace(md_content, chr(10), '\n')
    WHEN type = 'collection' THEN '# ' || title || '\n\nThis section contains the following documents:'
    ELSE '# ' || title || '\n\nContent not available.' END"""


def with_attachment_flag(fx, items):
    have = fx.listed.select("page_id").distinct().withColumn("has_attachments", F.lit(True))
    return items.join(have, "page_id", "left").withColumn(
        "has_attachments", F.coalesce("has_attachments", F.lit(False)))


@query("document_payload", rf"""
    SELECT i.space_key, array_to_string(i.path, '/') AS path, '{{"title":"' || i.title || '","text":"' || text || '","collectionId":"' || collection_id
      || '","publish":true' || CASE WHEN up IS NULL THEN '' ELSE ',"parentDocumentId":"' || up || '"' END || '}}' AS request FROM (
      SELECT i.*, s.collection_id, {STUBBED} AS text, CASE WHEN depth > 2 THEN (SELECT any_value(p.page_uuid) FROM fx_items p
          WHERE p.space_key = i.space_key AND p.path = i.parent_path) END AS up
      FROM fx_items i JOIN fx_spaces s ON s.space_key = i.space_key
      LEFT JOIN (SELECT DISTINCT page_id FROM fx_att) a ON a.page_id = i.page_id) i""")
def _(fx):
    items = sync.with_parent_uuid(with_attachment_flag(fx, fx.items)).join(
        fx.spaces.select("space_key", "collection_id"), "space_key")
    return sync.document_payload(items).select("space_key", label().alias("path"), F.to_json("request").alias("request"))


@query("update_payload", r"""
    SELECT space_key, array_to_string(path, '/') AS path, '{"id":"' || page_uuid || '","text":"' || CASE WHEN md_content = ''
      THEN '# ' || title || '\n\nContent not available.' ELSE replace(md_content, chr(10), '\n') END || '","publish":true}' AS request
    FROM fx_items WHERE page_uuid IS NOT NULL AND created""")
def _(fx):
    return sync.update_payload(fx.items.where("page_uuid is not null and created")).select(
        "space_key", label().alias("path"), F.to_json("request").alias("request"))


@query("update_payload_partial", r"""
    SELECT id, '{"id":"' || id || '"' || CASE WHEN k % 2 = 0 THEN ',"title":"' || title || '"' ELSE '' END
      || CASE WHEN k % 3 = 0 THEN ',"text":"' || replace(text, chr(10), '\n') || '"' ELSE '' END || '}' AS request
    FROM (SELECT *, CAST(regexp_extract(id, '[0-9]+') AS BIGINT) AS k FROM fx_docs)""")
def _(fx):
    k = F.regexp_extract("id", "[0-9]+", 0).cast("long")
    return sync.partial_update_payload(fx.documents.select(
        "id", F.when(k % 2 == 0, F.col("title")).alias("title"), F.when(k % 3 == 0, F.col("text")).alias("text")))


@query("collection_payload_legacy", """
    SELECT s_suppkey, '{"name":"' || s_name || '","description":"Imported from Confluence space: s' || s_suppkey
      || '","color":"#4E5C6E","private":false}' AS request FROM supplier""")
def _(fx):
    return sync.collection_payload(fx.supplier_spaces, fx.items, legacy=True).select(
        F.substring("space_key", 2, 20).cast("long").alias("s_suppkey"), F.to_json("request").alias("request"))


@query("content_update_needed", """
    SELECT space_key, array_to_string(path, '/') AS path, md_content <> '' OR pos % 2 = 0 AS needed FROM fx_items""")
def _(fx):
    new = F.when(F.col("pos") % 2 == 0, F.concat("md_content", F.lit("\nmore"))).otherwise(F.col("md_content"))
    return fx.items.select("space_key", label().alias("path"),
                           sync.content_update_needed("md_content", new).alias("needed"))


@query("page_upload_plan", r"""
    SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS title,
      md5(html) AS text_md5, 'col-0' AS collection_id, CASE WHEN page_id % 4 <> 0 THEN 'doc-' || page_id END AS document_id,
      CASE WHEN page_id % 4 = 0 THEN 'HTTP 500' END AS error FROM pages""")
def _(fx):
    p = F.col("page_id")
    done = fx.table("pages").select(
        "page_id", F.when(p % 4 != 0, F.concat(F.lit("doc-"), p.cast("string"))).alias("document_id"),
        F.when(p % 4 == 0, "HTTP 500").alias("error"))
    return sync.page_upload_plan(fx.table("pages"), "col-0", done).select(
        "page_id", "request.title", F.md5("request.text").alias("text_md5"),
        F.col("request.collectionId").alias("collection_id"), "document_id", "error")


# ---------------------------------------------------------------- retries

@query("retry_schedule", """
    SELECT event_id, round(CASE WHEN attempt >= 5 THEN NULL WHEN network_error THEN least(attempt + 1.0, 10.0)
      WHEN status_code = 429 THEN greatest(least(pow(2, attempt) + (event_id % 10) / 10.0, 60.0), coalesce(retry_after, 0.0)) END, 4)::DOUBLE AS delay
    FROM fx_try""")
def _(fx):
    return sync.retry_schedule(fx.attempts, (F.col("event_id") % 10) / 10.0).select(
        "event_id", F.round("delay", 4).alias("delay"))


@query("attachment_waits", """
    SELECT path, CASE WHEN l_linenumber % 3 = 0 THEN 0.0 ELSE pow(2, l_linenumber % 3) * 2 END::DOUBLE AS upload_wait,
      (pow(2, l_linenumber % 3) * 2)::DOUBLE AS record_wait FROM fx_att""")
def _(fx):
    n = F.col("l_linenumber") % 3
    return fx.attachments.select("path", sync.attachment_wait(n).alias("upload_wait"),
                                 sync.attachment_record_wait(n).alias("record_wait"))


@query("retry_outcome", "SELECT request_id, outcome, attempts, status_code FROM fx_outcome")
def _(fx):
    return sync.retry_outcome(sync.live_attempts(fx.attempts))


@query("error_action", """
    SELECT event_id, CASE WHEN status_code = 429 THEN 'retry' WHEN status_code = 500 THEN CASE WHEN attempt < 5 THEN 'retry' ELSE 'fail' END
      WHEN status_code = 200 THEN 'none' ELSE 'skip' END AS error_action FROM fx_try""")
def _(fx):
    return sync.error_action(fx.attempts).select("event_id", "error_action")


@query("item_errors", """
    SELECT item, seq, error, row_number() OVER (PARTITION BY item ORDER BY seq) - 1 AS retry_count
    FROM fx_results WHERE NOT success AND error <> 'open'""")
def _(fx):
    return sync.item_errors(fx.results.where("not success and error <> 'open'")).select("item", "seq", "error", "retry_count")


@query("collection_errors", """
    SELECT item AS space_key, error, count(*) AS times, min(seq) AS first_seq, max(seq) AS last_seq
    FROM fx_results WHERE NOT success GROUP BY ALL""")
def _(fx):
    return sync.collection_errors(fx.results.where("not success").withColumnRenamed("item", "space_key"))


@query("collection_error_records", """
    SELECT item AS space_key, seq, error, row_number() OVER (PARTITION BY item ORDER BY seq) - 1 AS retry_count FROM fx_results WHERE NOT success""")
def _(fx):
    return sync.collection_error_records(fx.results.where("not success").withColumnRenamed("item", "space_key")).select(
        "space_key", "seq", "error", "retry_count")


# ---------------------------------------------------------------- state

@query("merge_state", """
    SELECT space_key, array_to_string(path, '/') AS path,
      CASE WHEN pos % 2 = 0 AND pos % 5 <> 0 THEN 'new-' || pos ELSE page_uuid END AS page_uuid,
      CASE WHEN pos % 2 = 0 AND pos % 5 <> 0 THEN 'par-' || pos END AS parent_uuid,
      CASE WHEN pos % 2 = 0 THEN pos % 5 <> 0 ELSE created END AS created FROM fx_items""")
def _(fx):
    ok, pos = F.col("pos") % 5 != 0, F.col("pos").cast("string")
    outcomes = fx.items.where("pos % 2 = 0").select(
        "space_key", "path", F.when(ok, F.concat(F.lit("new-"), pos)).alias("page_uuid"),
        F.concat(F.lit("par-"), pos).alias("parent_uuid"), ok.alias("created"))
    return sync.merge_state(fx.items, outcomes).select(
        "space_key", label().alias("path"), "page_uuid", "parent_uuid", "created")


WAVES = """(SELECT i.*, s.collection_id, p.pos AS up, i.depth > 1 AND i.pos % 7 = 3 AS bad, EXISTS (
      SELECT 1 FROM fx_items f WHERE f.space_key = i.space_key AND f.depth > 1 AND f.depth < i.depth AND f.pos % 7 = 3 AND f.path = i.path[1:f.depth]) AS lost
    FROM fx_items i JOIN fx_spaces s ON s.space_key = i.space_key LEFT JOIN fx_items p ON p.space_key = i.space_key AND p.path = i.parent_path)"""


def run(fx, failing: bool):
    """All waves over fresh items; every seventh request fails, or none."""
    ok = (F.col("pos") % 7 != 3) if failing else F.lit(True)
    outcomes = fx.items.select("space_key", "path", F.when(ok, F.concat_ws("-", F.lit("new"), "space_key", F.col("pos").cast("string"))).alias("page_uuid"),
                               ok.alias("created"))
    return sync.run_waves(sync.reset_state(fx.items), fx.spaces, outcomes)


@query("sync_run", f"""
    SELECT space_key, array_to_string(path, '/') AS path, CASE WHEN lost THEN 'not attempted' WHEN bad THEN 'failed' ELSE 'created' END AS upload_state,
      CASE WHEN depth = 1 THEN collection_id WHEN NOT lost AND NOT bad THEN 'new-' || space_key || '-' || pos END AS page_uuid,
      CASE WHEN depth > 2 AND NOT lost AND NOT bad THEN 'new-' || space_key || '-' || up END AS parent_uuid, NOT lost AND NOT bad AS created FROM {WAVES}""")
def _(fx):
    return run(fx, True).select("space_key", label().alias("path"), "upload_state", "page_uuid", "parent_uuid", "created")


@query("sync_run_success", """
    SELECT space_key, count(*) AS total_items, count(*) AS created_items, true AS upload_successful FROM fx_items GROUP BY 1""")
def _(fx):
    return status.upload_status(run(fx, False)).select("space_key", "total_items", "created_items", "upload_successful")


@query("reset_state", """
    SELECT space_key, array_to_string(path, '/') AS path, created AND space_key NOT IN ('asia', 'europe') AS created,
      CASE WHEN space_key NOT IN ('asia', 'europe') THEN page_uuid END AS page_uuid FROM fx_items""")
def _(fx):
    return sync.reset_state(fx.items, ["asia", "europe"]).select("space_key", label().alias("path"), "created", "page_uuid")


@query("resume_batch", "SELECT space_key, array_to_string(path, '/') AS path FROM fx_items WHERE NOT created")
def _(fx):
    return sync.resume_batch(fx.items, fx.items.select("space_key", "path", "created")).select("space_key", label().alias("path"))


# ---------------------------------------------------------------- documented extras

def plan(fx):
    files = fx.listed.groupBy("page_id").agg(F.count(F.lit(1)).alias("attachments"),
                                             F.count_if(F.col("ord") % 9 == 0).alias("missing_files"))
    return (sync.sync_action(fx.items, fx.documents, fx.spaces).join(files, "page_id", "left")
            .na.fill(0, ["attachments", "missing_files"]))


@query("dry_run_report", f"""
    SELECT space_key, {NORMAL} AS action, count(*) AS documents, CAST(sum(coalesce(n, 0)) AS BIGINT) AS attachments,
      CAST(sum(coalesce(m, 0)) AS BIGINT) AS missing_files
    FROM {ACTION} i LEFT JOIN (SELECT page_id AS pid, count(*) AS n, count(*) FILTER (ord % 9 = 0) AS m FROM fx_att GROUP BY 1) ON pid = page_id
    GROUP BY ALL""")
def _(fx):
    return sync.dry_run_report(plan(fx))


@query("dry_run_violations", """
    SELECT * FROM (WITH i AS (SELECT * REPLACE (CASE WHEN pos % 13 = 0 THEN '  ' WHEN pos % 17 = 0 THEN repeat('x', 300) ELSE title END AS title),
        CASE WHEN pos % 19 <> 0 THEN href END AS html_page FROM fx_items WHERE NOT (depth = 2 AND pos % 4 = 0)),
    v AS (SELECT space_key, path, 'blank title' AS rule, NULL AS detail FROM i WHERE trim(title) = ''
      UNION ALL SELECT space_key, path, 'long title', CAST(length(title) AS VARCHAR) FROM i WHERE length(title) > 255
      UNION ALL SELECT space_key, path, 'orphan', parent_path[-1] FROM i WHERE depth > 1 AND NOT EXISTS (
        SELECT 1 FROM i p WHERE p.space_key = i.space_key AND p.path = i.parent_path)
      UNION ALL SELECT space_key, path, 'page without file', href FROM i WHERE type = 'page' AND html_page IS NULL
      UNION ALL SELECT space_key, path, 'unknown space', space_key FROM i WHERE space_key = 'asia'
      UNION ALL SELECT i.space_key, i.path, 'missing file', a.path FROM i JOIN fx_att a ON a.page_id = i.page_id WHERE a.ord % 9 = 0)
    SELECT space_key, array_to_string(path, '/') AS path, rule, detail FROM v)""")
def _(fx):
    pos = F.col("pos")
    items = fx.items.where("NOT (depth = 2 AND pos % 4 = 0)").withColumns({
        "title": F.when(pos % 13 == 0, "  ").when(pos % 17 == 0, F.repeat(F.lit("x"), F.lit(300))).otherwise(F.col("title")),
        "html_page": F.when(pos % 19 != 0, F.col("href"))})
    return sync.dry_run_violations(items, fx.spaces.where("space_key <> 'asia'"), fx.listed.select("page_id", "path"),
                                   fx.listed.where("ord % 9 <> 0").select("page_id", "path")).withColumn("path", label())


@query("work_estimate", f"""
    SELECT *, CAST(ceil((creates + updates) / 10) AS BIGINT) AS batches, CAST(ceil(requests / 60) AS BIGINT) AS minutes FROM (
      SELECT *, creates + updates + 2 * attachments AS requests FROM (
        SELECT space_key, count(*) FILTER (act = 'create') AS creates, count(*) FILTER (act = 'update') AS updates, count(*) FILTER (act = 'skip') AS skips,
          CAST(sum(coalesce(n, 0)) AS BIGINT) AS attachments, CAST(sum(coalesce(b, 0)) AS BIGINT) AS bytes, CAST(max(depth) AS INTEGER) AS waves
        FROM (SELECT *, {NORMAL} AS act FROM {ACTION} i) LEFT JOIN (SELECT page_id AS pid, count(*) AS n, sum(size) AS b FROM fx_att GROUP BY 1) ON pid = page_id
        GROUP BY 1))""")
def _(fx):
    files = fx.attachments.groupBy("page_id").agg(F.count(F.lit(1)).alias("attachments"), F.sum("size").alias("bytes"))
    return sync.work_estimate(sync.sync_action(fx.items, fx.documents, fx.spaces).join(files, "page_id", "left"))


@query("batch_assign", """
    SELECT array_to_string(path, '/') AS path, depth - 1 AS wave, (row_number() OVER (PARTITION BY space_key, depth ORDER BY pos, path) - 1) // 10 AS batch FROM fx_items""")
def _(fx):
    return sync.batch_assign(sync.sync_waves(fx.items)).select(label().alias("path"), "wave", "batch")


@query("verify_upload", """
    SELECT coalesce(i.page_uuid, d.id) AS id, CASE WHEN d.id IS NULL THEN 'missing' WHEN i.page_uuid IS NULL THEN 'extra'
      WHEN i.md_content = d.text THEN 'equal' ELSE 'changed' END AS verdict
    FROM (SELECT * FROM fx_items WHERE page_uuid IS NOT NULL) i FULL JOIN fx_docs d ON d.id = i.page_uuid""")
def _(fx):
    return sync.verify_upload(fx.items, fx.documents)


@query("verify_tree", """
    SELECT * FROM (WITH i AS (SELECT i.*, CASE WHEN i.depth > 2 THEN p.page_uuid END AS up FROM fx_items i
      LEFT JOIN fx_items p ON p.space_key = i.space_key AND p.path = i.parent_path WHERE i.depth > 1),
    r AS (SELECT d.id, d.text, CASE WHEN d.id LIKE '%7' THEN 'nat-0' ELSE i.up END AS parent_id FROM fx_docs d LEFT JOIN i ON i.page_uuid = d.id),
    f AS (SELECT a.page_id, count(*) FILTER (NOT coalesce(d.uploaded, false)) AS lost FROM fx_att a
      LEFT JOIN fx_det d ON d.page_id = a.page_id AND d.path = a.path GROUP BY 1),
    v AS (SELECT i.space_key, i.path, coalesce(i.page_uuid, r.id) AS id, CASE WHEN i.path IS NULL THEN 'extra' WHEN page_uuid IS NULL THEN 'not uploaded'
        WHEN r.id IS NULL THEN 'missing' WHEN md_content IS NOT DISTINCT FROM r.text THEN 'equal' ELSE 'changed' END AS content,
      r.id IS NOT NULL AND i.path IS NOT NULL AND up IS DISTINCT FROM parent_id AS moved, coalesce(lost, 0) AS missing_files
      FROM i FULL JOIN r ON r.id = i.page_uuid LEFT JOIN f ON f.page_id = i.page_id),
    b AS (SELECT space_key, list_transform(range(1, len(path) + 1), lambda n: path[1:n]) AS above FROM v
      WHERE path IS NOT NULL AND (content <> 'equal' OR moved OR missing_files > 0)),
    c AS (SELECT space_key, path, count(*) AS below FROM (SELECT space_key, unnest(above) AS path FROM b) GROUP BY ALL)
    SELECT v.space_key, array_to_string(v.path, '/') AS path, id, content, moved, missing_files, coalesce(below, 0) AS below
    FROM v LEFT JOIN c ON c.space_key = v.space_key AND c.path = v.path)""")
def _(fx):
    expected = sync.with_parent_uuid(fx.items).where("page_uuid IS NOT NULL").select(F.col("page_uuid").alias("id"), "parent_uuid")
    remote = fx.documents.join(expected, "id", "left").withColumn(
        "parent_id", F.when(F.col("id").endswith("7"), "nat-0").otherwise(F.col("parent_uuid")))
    return sync.verify_tree(fx.items, remote, fx.listed, fx.details).withColumn("path", label())


CREATED = """(SELECT 'attachment' AS kind, attachment_id AS id, ord AS seq, 1 AS rank FROM fx_det WHERE uploaded
    UNION ALL SELECT 'document', id, CAST(regexp_extract(id, '[0-9]+') AS BIGINT), 2 FROM fx_docs
    UNION ALL SELECT 'collection', collection_id, CAST(regexp_extract(collection_id, '[0-9]+') AS BIGINT), 3 FROM fx_spaces)"""


def created(fx):
    number = F.regexp_extract("id", "[0-9]+", 0).cast("long")
    a = fx.details.where("uploaded").select(F.lit("attachment").alias("kind"), F.col("attachment_id").alias("id"), F.col("ord").alias("seq"))
    d = fx.documents.select(F.lit("document").alias("kind"), "id", number.alias("seq"))
    c = fx.spaces.select(F.lit("collection").alias("kind"), F.col("collection_id").alias("id")).withColumn("seq", number)
    return a.unionByName(d).unionByName(c)


@query("rollback_plan", f"SELECT kind, id, seq, rank FROM {CREATED}")
def _(fx):
    return sync.rollback_plan(created(fx))


@query("skip_attachments", f"SELECT kind, id FROM {CREATED} WHERE kind <> 'attachment'")
def _(fx):
    return sync.skip_attachments(created(fx)).select("kind", "id")


@query("progress_report", """
    SELECT kind, done, total, failures, round(100.0 * done / total, 4)::DOUBLE AS percent, round((total - done) * 600.0 / done, 4)::DOUBLE AS remaining_seconds FROM (
      SELECT 'documents' AS kind, count(*) FILTER (created) AS done, count(*) AS total, count(*) FILTER (NOT created AND page_uuid IS NULL) AS failures FROM fx_items
      UNION ALL SELECT 'attachments', count(*) FILTER (uploaded), count(*), count(*) FILTER (NOT uploaded AND upload_failed_at IS NOT NULL) FROM fx_det)""")
def _(fx):
    items = fx.items.withColumn("failed", F.col("page_uuid").isNull())
    return status.progress_report(items, fx.details, 600.0).withColumns({
        "percent": F.round("percent", 4), "remaining_seconds": F.round("remaining_seconds", 4)})


@query("cross_reference_update", """
    SELECT pos, CASE WHEN page_uuid IS NULL THEN '[me](' || href || ')' ELSE '[me](https://kb/doc/' || page_uuid || ')' END
      || ' and [top](https://kb/doc/' || top_uuid || ') or [gone](Gone_' || pos || '.html)' AS content FROM (
      SELECT i.*, r.page_uuid AS top_uuid FROM fx_items i JOIN fx_items r ON r.space_key = i.space_key AND r.depth = 1)""")
def _(fx):
    top = fx.items.where("depth = 1").select("space_key", F.col("href").alias("top"))
    contents = fx.items.join(top, "space_key").select(
        "space_key", F.col("pos").alias("page_id"), F.concat(
            F.lit("[me]("), "href", F.lit(") and [top]("), "top", F.lit(") or [gone](Gone_"),
            F.col("pos").cast("string"), F.lit(".html)")).alias("content"))
    uuids = fx.items.where("page_uuid is not null")
    return sync.cross_reference_update(contents, uuids, "https://kb").select(F.col("page_id").alias("pos"), "content")
