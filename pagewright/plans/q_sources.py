"""Scans, sinks and the incremental run."""
from pyspark.sql import functions as F

from pagewright.functions.text import basename
from pagewright.operators import archives, legacy
from pagewright.plans.q_markdown import CLEAN
from pagewright.plans.q_status import raw_files
from pagewright.plans.registry import label, query
from pagewright.session import scratch_path
from pagewright.sources import files, spaces, zips
from pagewright.streaming.resume import current_pages, resume_stream


@query("scan_pages", "SELECT md5(html) AS md5, CAST(length(html) AS INTEGER) AS chars FROM pages")
def _(fx):
    folder = scratch_path(fx.spark, "export")
    # files are made, and put in place, by all tasks and not by the few that the table has or by the driver
    tasks = 2 * fx.spark.sparkContext.defaultParallelism
    fx.table("pages").select("html").repartition(tasks).write.option("maxRecordsPerFile", 1).option(
        "mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
    html = F.regexp_replace("html", r"\n\z", "")  # the text sink ends each file with a line feed
    return files.scan_pages(fx.spark, folder, "*.txt").select(F.md5(html).alias("md5"), F.length(html).alias("chars"))


def archive_folder(fx):
    """The archives of the pages as files in a folder of their own, written by the tasks."""
    folder = scratch_path(fx.spark, "zips").removeprefix("file://")

    def write(batches):
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(folder)
        system.create_dir(place)
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with system.open_output_stream(f"{place}/{path.split('/')[-1]}") as out:
                    out.write(content)
            yield pdf[["path"]]

    fx.page_archives.mapInPandas(write, "path string").count()
    return folder


# a stored member takes 30 + 46 bytes of headers, its name twice and its content; the end record 22
@query("scan_archives", """
    SELECT 'page-' || page_id || '.html.zip' AS name, CASE WHEN page_id % 10 = 9 THEN 10
        ELSE 22 + 2 * 76 + 2 * (length('IS/index.html') + length('IS/Page_' || (30000000 + page_id) || '.html'))
          + octet_length(encode(url)) + octet_length(encode(html)) END AS archive_size,
      CASE WHEN page_id % 10 = 9 THEN 0 ELSE 2 END::BIGINT AS members, CASE WHEN page_id % 10 = 9 THEN 'Invalid or corrupted zip file' END AS error FROM pages""")
def _(fx):
    return zips.scan_archives(fx.spark, archive_folder(fx)).select(basename("zip_file").alias("name"), "archive_size", "members", "error")


@query("read_archive_members", """
    SELECT 'page-' || page_id || '.html.zip' AS name, 'IS/Page_' || (30000000 + page_id) || '.html' AS member, octet_length(encode(html)) AS file_size,
      md5(html) AS md5 FROM pages WHERE page_id % 10 <> 9
    UNION ALL SELECT 'page-' || page_id || '.html.zip', 'IS/index.html', octet_length(encode(url)), md5(url) FROM pages WHERE page_id % 10 <> 9""")
def _(fx):
    members = zips.scan_members(fx.spark, archive_folder(fx))
    admitted = archives.admitted(members)
    return zips.read_members(admitted).select(
        basename("zip_file").alias("name"), "member", F.octet_length("content").cast("long").alias("file_size"), F.md5("content").alias("md5"))


@query("scan_zip_members", """
    SELECT 'zips/page-' || page_id || '.html.zip' AS zip_file, CASE WHEN page_id % 10 <> 9 THEN 'IS/index.html' END AS member,
      CASE WHEN page_id % 10 <> 9 THEN octet_length(encode(url)) END AS file_size, CASE WHEN page_id % 10 = 9 THEN 'Invalid or corrupted zip file' END AS error FROM pages
    UNION ALL SELECT 'zips/page-' || page_id || '.html.zip', 'IS/Page_' || (30000000 + page_id) || '.html', octet_length(encode(html)), NULL
    FROM pages WHERE page_id % 10 <> 9""")
def _(fx):
    return files.scan_zip_members(fx.page_archives)


@query("read_zip_members", """
    SELECT 'zips/page-' || page_id || '.html.zip' AS zip_file, 'IS/Page_' || (30000000 + page_id) || '.html' AS member, md5(html) AS md5
    FROM pages WHERE page_id % 10 <> 9
    UNION ALL SELECT 'zips/page-' || page_id || '.html.zip', 'IS/index.html', md5(url) FROM pages WHERE page_id % 10 <> 9""")
def _(fx):
    admitted = archives.admitted(files.scan_zip_members(fx.page_archives))
    return files.read_zip_members(fx.page_archives, admitted).select("zip_file", "member", F.md5("content").alias("md5"))


@query("discover_spaces", """
    SELECT DISTINCT split_part(path, '/', 2) AS export, split_part(path, '/', 3) AS folder FROM fx_paths
    WHERE ends_with(path, '/index.html') AND starts_with(path, 'input/Export-')""")
def _(fx):
    return files.discover_spaces(fx.file_paths)


@query("list_exports", "SELECT DISTINCT split_part(path, '/', 2) AS export FROM fx_paths")
def _(fx):
    return files.list_exports(fx.file_paths)


# ---------------------------------------------------------------- space documents

def nested_documents(fx):
    """One nested space document per customer: region → nation → customer, and a second root."""
    def item(title, children=None):
        kids = F.array(children) if children is not None else F.array()
        return F.struct(title.alias("title"), F.lit("page").alias("type"), F.lit(False).alias("created"),
                        F.array(F.concat(F.lit("attachments/"), title)).alias("attachments"), kids.alias("children"))

    c = (fx.table("customer").join(fx.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(fx.table("region"), F.col("n_regionkey") == F.col("r_regionkey")))
    chain = item(F.col("r_name"), item(F.col("n_name"), item(F.col("c_name"))))
    doc = F.struct(
        F.col("c_name").alias("space_name"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("space_key"),
        F.struct(F.col("c_custkey").cast("int").alias("total_pages")).alias("processing_stats"),
        F.array(F.to_json(chain), F.to_json(item(F.col("c_mktsegment")))).alias("space_content"))
    return c.select("c_custkey", doc.alias("d"))


def json_texts(fx):
    """The documents as JSON text; items of different shape are spliced in as text."""
    d = F.col("d")
    head = F.to_json(F.struct("d.space_name", "d.space_key", "d.processing_stats"))
    return nested_documents(fx).select(F.concat(
        F.regexp_replace(head, r"\}\z", ""), F.lit(',"space_content":['),
        F.array_join(d["space_content"], ","), F.lit("]}")).alias("json"))


CUST = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query("scan_space_json", "SELECT 'c' || c_custkey AS space_key, c_name AS space_name, CAST(c_custkey AS INTEGER) AS total_pages, 2 AS roots FROM customer")
def _(fx):
    folder = scratch_path(fx.spark, "spaces-json")
    json_texts(fx).write.text(folder)
    return spaces.scan_space_json(fx.spark, folder, multiline=False).select(
        "space_key", "space_name", "processing_stats.total_pages", F.size("space_content").alias("roots"))


@query("flatten_space_json", f"""
    SELECT 'c' || c_custkey AS space_key, r_name AS path, 1 AS depth, r_name AS title, 'attachments/' || r_name AS attachments FROM {CUST}
    UNION ALL SELECT 'c' || c_custkey, r_name || '/' || n_name, 2, n_name, 'attachments/' || n_name FROM {CUST}
    UNION ALL SELECT 'c' || c_custkey, r_name || '/' || n_name || '/' || c_name, 3, c_name, 'attachments/' || c_name FROM {CUST}
    UNION ALL SELECT 'c' || c_custkey, c_mktsegment, 1, c_mktsegment, 'attachments/' || c_mktsegment FROM customer""")
def _(fx):
    docs = spaces.parse_space_json(json_texts(fx))
    return spaces.flatten_space_json(docs.select("space_key", "space_content")).select(
        "space_key", label().alias("path"), "depth", "title", F.array_join("attachments", ",").alias("attachments"))


@query("nest_space_json", """
    SELECT space_key, parent_path, chunk, '[' || string_agg('{"title":"' || title || '","type":"' || type || '"' || CASE WHEN page_uuid IS NULL THEN ''
      ELSE ',"page_uuid":"' || page_uuid || '"' END || ',"created":' || created || '}', ',' ORDER BY pos) || ']' AS children
    FROM (SELECT *  EXCLUDE (parent_path), array_to_string(parent_path, '/') AS parent_path,
            (row_number() OVER (PARTITION BY space_key, parent_path ORDER BY pos) - 1) // 1000 AS chunk FROM fx_items)
    GROUP BY space_key, parent_path, chunk""")
def _(fx):
    return spaces.nest_space_json(fx.items, ["title", "type", "page_uuid", "created"]).select(
        "space_key", label("parent_path").alias("parent_path"), "chunk", "children")


@query("sink_space_json", "SELECT space_key, array_to_string(path, '/') AS path, pos, title, created, page_uuid FROM fx_items")
def _(fx):
    folder = scratch_path(fx.spark, "spaces")
    items = fx.items.select("space_key", "path", "pos", "title", "created", "page_uuid")
    spaces.write_spaces(items, folder)
    return spaces.read_spaces(fx.spark, folder, items.schema).withColumn("path", label())


@query("sink_clean_pages", f"""
    SELECT 'clean_' || filename AS output, md5('# Doc' || chr(10) || chr(10) || t) AS md5 FROM {CLEAN} WHERE ok""")
def _(fx):
    folder = scratch_path(fx.spark, "clean")
    spaces.write_clean(legacy.clean_files(raw_files(fx)), folder)
    return fx.spark.read.parquet(folder).select("output", F.md5("body").alias("md5"))


@query("resume_stream", """
    SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 2 ELSE 1 END::INTEGER AS page_version,
      len(regexp_extract_all(html, '<a '))::INTEGER + CASE WHEN page_id % 4 = 1 THEN 1 ELSE 0 END::INTEGER AS links,
      md5(CASE WHEN page_id % 4 = 1 THEN html || '<a ' ELSE html END) AS md5 FROM pages""")
def _(fx):
    target, checkpoint, source = (scratch_path(fx.spark, f"resumed-{n}") for n in ("out", "state", "in"))
    pages = fx.table("pages").select("page_id", "html")
    changed = pages.withColumn("html", F.when(F.col("page_id") % 4 == 1, F.concat("html", F.lit("<a "))).otherwise(F.col("html")))

    def step(batch):
        return batch.select("page_id", "page_version", F.size(F.regexp_extract_all("html", F.lit("<a "), F.lit(0))).alias("links"),
                            F.md5("html").alias("md5"))

    # at first a part of the pages; then all, some new, some changed and some as before; then nothing more
    for arrived in (pages.where("page_id % 4 <> 0"), changed, None):
        if arrived is not None:
            arrived.write.mode("append").parquet(source)
        resume_stream(fx.spark, source, pages.schema, checkpoint, target, step).awaitTermination()
    return current_pages(fx.spark, target)
