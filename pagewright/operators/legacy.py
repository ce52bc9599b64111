"""The legacy page pipeline: markdown pages with breadcrumbs → cleaned pages and navigation."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import fixed
from pagewright.functions import markdown as md
from pagewright.functions.text import detect_content_type, page_id_from_filename
from pagewright.operators import attachments, dom


def clean_files(pages: DataFrame) -> DataFrame:
    """Type, title, breadcrumb, content and sizes per page; an error row where text is missing.

    ``pages`` carries (page_id, filename, raw). HTML and markdown rows take their own way and
    meet in one table; the HTML way shuffles once by page id.
    """
    typed = pages.where("raw is not null").withColumn("content_type", detect_content_type("raw"))
    sized = typed.withColumn("original_size", F.length("raw").cast("long"))
    as_html = sized.where("content_type = 'html'")
    html = as_html.drop("raw").join(
        dom.legacy_pages(as_html.select("page_id", F.col("raw").alias("html"))), "page_id", "left")
    text = (sized.where("content_type <> 'html'")
            .withColumns({"title": md.title_from_markdown("raw"), "breadcrumb": md.breadcrumb_block("raw"),
                          "markdown": F.col("raw")}).drop("raw"))
    done = (html.unionByName(text)
            .withColumn("clean_content", md.post_process_markdown(F.coalesce("markdown", F.lit(""))))
            .select("page_id", "filename", F.coalesce("title", F.lit("")).alias("title"),
                    F.coalesce("breadcrumb", F.lit("")).alias("breadcrumb"), "clean_content",
                    "original_size", F.length("clean_content").cast("long").alias("cleaned_size"),
                    "content_type", F.lit(None).cast("string").alias("error")))
    lost = pages.where("raw is null").select(
        "page_id", "filename", F.lit("Failed to read file").alias("error"))
    return done.unionByName(lost, allowMissingColumns=True)


def process_pages(pages: DataFrame, files: DataFrame) -> DataFrame:
    """Markdown pages → path, title, id, cleaned content and number of attachment files.

    ``pages`` carries (filename, content), ``files`` one row per attachment file with its
    page id. Feed the result to ``tree.integrated_navigation``.
    """
    read = (pages.withColumn("page_id", page_id_from_filename("filename"))
            .withColumn("crumbs", md.parse_breadcrumb("content"))
            .select("filename", "page_id", md.page_path("crumbs").alias("path"),
                    md.title_from_content("content").alias("title"),
                    md.clean_content_for_api("content").alias("content")))
    counts = files.groupBy("page_id").agg(F.count(F.lit(1)).alias("attachment_count"))
    return (read.join(counts, "page_id", "left")
            .withColumn("attachment_count", F.coalesce("attachment_count", F.lit(0)).cast("long")))


def detected_space_name(pages: DataFrame, default: str = fixed.DEFAULT_SPACE_NAME) -> DataFrame:
    """One row with the space name from the first ``index.html`` by path, else the default.

    ``pages`` carries (file_path, content).
    """
    index = F.col("file_path").rlike(r"(?:^|/)index\.html$")
    first = pages.agg(F.min_by(F.when(index, F.col("content")), F.when(index, F.col("file_path"))).alias("c"))
    return first.select(F.when(F.col("c").isNull(), default)
                        .otherwise(md.space_name_from_index("c", default)).alias("space_name"))


def attachments_from_content(pages: DataFrame, files: DataFrame) -> DataFrame:
    """Attachment files of pages with type, size and whether the text refers to them."""
    refs = pages.select("page_id", md.attachment_refs("content").alias("refs"))
    return attachments.with_referenced(attachments.inventory(files), refs)


