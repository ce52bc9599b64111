"""Roll-ups, first rows and milestones."""
from pyspark.sql import functions as F

from pagewright.operators import archives, status
from pagewright.plans.registry import query

SUMMARY = """(SELECT zip_file, 'Export-' || split_part(split_part(zip_file, 'export-', 2), '.', 1) AS folder_name, error IS NULL AS success,
    CASE WHEN error IS NULL THEN files - blocked ELSE 0 END AS files_extracted, CASE WHEN error IS NULL THEN blocked ELSE 0 END AS files_blocked, error
  FROM fx_zips)"""


@query("extraction_summary", f"SELECT * FROM {SUMMARY}")
def _(fx):
    return archives.extraction_summary(fx.zip_members, max_files=20)


@query("extraction_totals", f"""
    SELECT count(*) AS total_zips, count(*) FILTER (success) AS successful_extractions, count(*) FILTER (NOT success) AS failed_extractions,
      CAST(sum(files_extracted) AS BIGINT) AS files_extracted, CAST(sum(files_blocked) AS BIGINT) AS files_blocked FROM {SUMMARY}""")
def _(fx):
    return archives.extraction_totals(archives.extraction_summary(fx.zip_members, max_files=20))


def raw_files(fx):
    """Markdown documents as files, some of them unreadable."""
    return fx.table("documents").select(
        F.col("doc_id").alias("page_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("filename"),
        F.when(F.col("doc_id") % 17 != 0, F.concat(F.lit("# Doc\n\n"), "text", F.lit("   \n\n\n"))).alias("raw"))


@query("space_summary", """
    SELECT s.space_key, s.space_name, s.collection_id, '' AS description, count(*) AS total_items, count(*) FILTER (depth = 1) AS root_items
    FROM fx_spaces s JOIN fx_items i ON i.space_key = s.space_key GROUP BY ALL""")
def _(fx):
    return status.space_summary(fx.spaces.withColumn("description", F.lit(None).cast("string")), fx.items)


@query("upload_status", """
    SELECT s.space_key, s.collection_id, '2024-01-0' || (CAST(right(s.collection_id, 1) AS INTEGER) + 1) AS uploaded_at, coalesce(n, 0) AS total_items,
      coalesce(c, 0) AS created_items, coalesce(round(100.0 * c / n, 4)::DOUBLE, 0.0::DOUBLE) AS completion_percentage, coalesce(c = n, true) AS upload_successful
    FROM fx_spaces s LEFT JOIN (SELECT space_key, count(*) AS n, count(*) FILTER (created) AS c FROM fx_items GROUP BY 1) i ON i.space_key = s.space_key""")
def _(fx):
    day = F.concat(F.lit("2024-01-0"), (F.substring("collection_id", -1, 1).cast("int") + 1).cast("string"))
    return status.upload_status(fx.items, fx.spaces.withColumn("uploaded_at", day)).withColumn(
        "completion_percentage", F.round("completion_percentage", 4)).select(
        "space_key", "collection_id", "uploaded_at", "total_items", "created_items", "completion_percentage", "upload_successful")


@query("upload_success", "SELECT space_key, bool_and(created) AS upload_successful FROM fx_items GROUP BY 1")
def _(fx):
    return status.upload_status(fx.items).select("space_key", "upload_successful")


@query("status_report", """
    SELECT s.space_key, s.space_name, i.total_items, i.root_items, i.created_items, i.pct AS completion_percentage,
      a.total_attachments, a.uploaded_attachments, a.failed_attachments
    FROM fx_spaces s JOIN (SELECT space_key, count(*) AS total_items, count(*) FILTER (depth = 1) AS root_items, count(*) FILTER (created) AS created_items,
        round(100.0 * count(*) FILTER (created) / count(*), 4)::DOUBLE AS pct FROM fx_items GROUP BY 1) i ON i.space_key = s.space_key
    LEFT JOIN (SELECT space_key, count(*) AS total_attachments, count(*) FILTER (uploaded) AS uploaded_attachments,
        count(*) FILTER (NOT uploaded AND upload_failed_at IS NOT NULL) AS failed_attachments FROM fx_det GROUP BY 1) a ON a.space_key = s.space_key""")
def _(fx):
    spaces = fx.spaces.withColumn("description", F.lit(""))
    return status.status_report(spaces, fx.items, fx.details).select(
        "space_key", "space_name", "total_items", "root_items", "created_items",
        F.round("completion_percentage", 4).alias("completion_percentage"),
        "total_attachments", "uploaded_attachments", "failed_attachments")


@query("phase_success", """
    SELECT count(*) AS requested, count(*) FILTER (s_suppkey % 7 <> 0 AND s_suppkey % 3 <> 0) AS succeeded, false AS failed FROM supplier""")
def _(fx):
    key = F.regexp_extract("space_key", "[0-9]+", 0).cast("long")
    done = fx.supplier_spaces.where(key % 7 != 0).select("space_key", (key % 3 != 0).alias("success"))
    return status.phase_success(fx.supplier_spaces.select("space_key"), done)


@query("batch_results", """
    SELECT count(*) AS total_files, count(*) FILTER (success) AS successful_uploads, count(*) FILTER (NOT success) AS failed_uploads,
      sum(duration) AS duration, round(100.0 * count(*) FILTER (success) / count(*), 4)::DOUBLE AS success_rate FROM fx_results""")
def _(fx):
    return status.batch_results(fx.results).withColumn("success_rate", F.round("success_rate", 4))


@query("first_k_success", """
    SELECT file_path, success, error, rank FROM (SELECT *, CASE WHEN success THEN CAST(row_number() OVER (PARTITION BY success ORDER BY seq) AS INTEGER) END AS rank FROM fx_results)
    WHERE NOT success OR rank <= 3""")
def _(fx):
    return status.first_k_success(fx.results).select("file_path", "success", "error", "rank")


@query("progress_milestones", """
    SELECT seq, n AS current, total, n * 100.0::DOUBLE / total AS percent FROM (
      SELECT event_id AS seq, row_number() OVER (ORDER BY event_id) AS n, count(*) OVER () AS total FROM events)
    WHERE n = total OR n * 4 = total OR n * 2 = total OR n * 4 = total * 3""")
def _(fx):
    steps = fx.table("events").select(F.col("event_id").alias("seq"))
    return status.progress_milestones(steps).select("seq", F.col("current").cast("long").alias("current"), "total", "percent")


@query("sorted_files", "SELECT href FROM fx_links ORDER BY href")
def _(fx):
    return status.sorted_files(fx.links.select("href"), "href")
