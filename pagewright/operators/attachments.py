"""Attachments of pages: lists, inventories, references and rewriting.

Joins meet on the page id. Nothing gathers all attachments of a page: folds see only the
attachments whose path occurs in the page, and sections are cut into numbered chunks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import fixed, refs
from pagewright.functions.text import basename, col, is_image, with_mime_type
from pagewright.session import stage_small

CHUNK = 1000  # attachments per section chunk


def inventory(files: DataFrame, mime: DataFrame | None = None) -> DataFrame:
    """(page_id, path, name, mime_type, size_bytes) of attachment files."""
    named = files.withColumn("name", basename("path")).withColumnRenamed("size", "size_bytes")
    return with_mime_type(named, "name", table=mime)


def page_attachments(pages: DataFrame, files: DataFrame) -> DataFrame:
    """Files in the attachment directory of each page."""
    return pages.join(files, "page_id")


def attachment_hrefs(tokens: DataFrame, normalize_query: bool = False) -> DataFrame:
    """(page_id, pos, path): hrefs that start with ``attachments/``, relative steps removed.

    A query part stays, as it does in listings; ``normalize_query`` cuts it.
    """
    from pagewright.operators.dom import attr

    hrefs = (tokens.where("kind = 'open' and name = 'a'").withColumn("href", attr("href"))
             .where(F.col("href").startswith("attachments/")))
    clean = F.replace(F.replace("href", F.lit("../"), F.lit("")), F.lit("./"), F.lit(""))
    if normalize_query:
        clean = F.substring_index(clean, "?", 1)
    return hrefs.select("page_id", "pos", clean.alias("path"))


def page_attachments_union(listed: DataFrame, referenced: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Directory files, then references, each path once at its first place.

    ``listed`` and ``referenced`` carry (page_id, path, ord); the place is (source, ord).
    ``pages`` limits both to pages of spaces that have an attachment directory.
    """
    if pages is not None:
        listed, referenced = (t.join(pages.select("page_id"), "page_id", "left_semi") for t in (listed, referenced))
    both = (listed.select("page_id", "path", F.lit(0).alias("source"), F.col("ord").cast("long").alias("ord"))
            .unionByName(referenced.select("page_id", "path", F.lit(1).alias("source"),
                                           F.col("ord").cast("long").alias("ord"))))
    return (both.groupBy("page_id", "path").agg(F.min(F.struct("source", "ord")).alias("p"))
            .select("page_id", "path", "p.source", "p.ord"))


def with_referenced(files: DataFrame, page_refs: DataFrame) -> DataFrame:
    """Flag files whose name occurs in any reference of their page.

    ``page_refs`` holds one row per page, (page_id, refs array), bounded by the page text.
    """
    return (files.join(page_refs, "page_id", "left")
            .withColumn("referenced_in_content", F.coalesce(
                F.exists("refs", lambda r: r.contains(F.col("name"))), F.lit(False)))
            .drop("refs"))


def missing_files(listed: DataFrame, files: DataFrame) -> DataFrame:
    """Failure rows for listed attachments without a file."""
    return (listed.join(files.select("page_id", "path"), ["page_id", "path"], "left_anti")
            .withColumn("error", F.concat(F.lit("Attachment file not found: "), F.col("path"))))


def with_details(listed: DataFrame, details: DataFrame) -> DataFrame:
    """Listed attachments with their stored detail, if any."""
    return listed.join(details, ["page_id", "path"], "left")


def usable(details: DataFrame) -> DataFrame:
    """Uploaded details with a URL: the only ones that change a document."""
    return (details.where(F.col("uploaded") & (F.col("api_url") != ""))
            .withColumn("name", F.coalesce("name", basename("path")))
            .withColumn("image", is_image("content_type", "path")))


def _occurring(contents: DataFrame, details: DataFrame) -> DataFrame:
    """Usable details whose path occurs in the page text, gathered per page.

    Only such details can change the text, and a text holds no more of them than it has
    places for a path, so the gathered array is bounded by the page itself.
    """
    hits = (usable(details).join(contents.select("page_id", "content"), "page_id")
            .where(F.col("content").contains(F.col("path"))))
    return hits.groupBy("page_id").agg(F.collect_list(F.struct(
        "ord", "path", F.col("api_url").alias("url"), "name", "image")).alias("details"))


def replace_refs(contents: DataFrame, details: DataFrame) -> DataFrame:
    """(page_id, content): references replaced by the URLs of uploaded attachments."""
    found = _occurring(contents, details)
    new = F.when(F.col("details").isNull(), F.col("content")).otherwise(
        refs.apply_details("content", "details"))
    return contents.join(found, "page_id", "left").withColumn("content", new).drop("details")


def _linked(content: str = "content") -> Column:
    return col(content).contains(F.col("path")) | col(content).contains(F.col("api_url"))


def unlinked(contents: DataFrame, details: DataFrame) -> DataFrame:
    """Uploaded attachments whose path and URL both do not occur in the page text."""
    return (usable(details).join(contents.select("page_id", "content"), "page_id")
            .where(~_linked()).drop("content"))


def section_chunks(contents: DataFrame, details: DataFrame) -> DataFrame:
    """The attachment section of each page as (page_id, part, chunk, text).

    Parts 1 and 3 are headings, part 2 lists unlinked attachments and part 4 all details;
    each list is cut into chunks of ``CHUNK`` attachments. Concatenating in (part, chunk)
    order gives the whole section, at any number of attachments per page.
    """
    rows = usable(details).join(contents.select("page_id", "content"), "page_id").select(
        "page_id", "ord", "name", "api_url", "image", "content_type", "attachment_id",
        F.coalesce(~_linked(), F.lit(False)).cast("long").alias("loose"))
    # one shuffle to ranges of a page's attachments, one that numbers them there for both lists; texts are put together
    # in place, and only chunks that reach over the end of a range are shuffled once more
    ranged = stage_small(rows.repartitionByRange("page_id", "ord").withColumn("_range", F.spark_partition_id()), "section").select(
        F.struct("page_id", "_range").alias("at"), "ord", "name", "api_url", "image", "content_type", "attachment_id", "loose")
    page = Window.partitionBy("at.page_id")
    before = page.orderBy("at._range").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.groupBy("at").agg(F.sum("loose").alias("n2"), F.count(F.lit(1)).alias("n4"))
    shifts = counted.select("at", *[c for n in ("n2", "n4") for c in (
        n, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before"), F.sum(n).over(page).alias(f"{n}_all"))])
    so_far = Window.partitionBy("at").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    numbered = ranged.withColumns({"r2": F.sum("loose").over(so_far), "r4": F.count(F.lit(1)).over(so_far)}).join(shifts, "at")
    link = F.concat(F.lit("["), F.col("name"), F.lit("]("), F.col("api_url"), F.lit(")"))
    loose = (F.when(F.col("image"), F.concat(F.lit("!"), link, F.lit("\n\n")))
             .otherwise(F.concat(F.lit("- "), link, F.lit("\n"))))
    fact = F.concat(F.lit("- **Content Type:** "), F.coalesce("content_type", F.lit("")),
                    F.lit(" **Original Name:** "), F.col("name"),
                    F.lit(" **Uploaded UUID:** "), F.coalesce("attachment_id", F.lit("")), F.lit("\n"))

    def entry(part: int, line: Column) -> Column:
        first, last = F.col(f"n{part}_before"), F.col(f"n{part}_before") + F.col(f"n{part}")
        rn = first + F.col(f"r{part}")
        chunk = F.floor((rn - 1) / CHUNK).cast("long")
        inside = (chunk * CHUNK >= first) & (F.least((chunk + 1) * CHUNK, F.col(f"n{part}_all")) <= last)
        return F.struct(F.lit(part).alias("part"), chunk.alias("chunk"), inside.alias("inside"), rn.alias("rn"), line.alias("line"))

    lines = numbered.select("at", F.explode(F.array(F.when(F.col("loose") > 0, entry(2, loose)), entry(4, fact))).alias("l")) \
        .where("l is not null").select("at", "l.*")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "line"))), lambda r: r["line"]), "").alias("text")
    body = (lines.where("inside").groupBy("at", "part", "chunk").agg(text).select("at.page_id", "part", "chunk", "text")
            .unionByName(lines.where("not inside").groupBy("at.page_id", "part", "chunk").agg(text)))
    parts = counted.groupBy("at.page_id").agg((F.sum("n2") > 0).alias("any_loose"))
    heads = parts.select("page_id", F.explode(F.array(
        F.struct(F.lit(1).alias("part"), F.concat(
            F.lit("\n\n## Original Attachments\n\n"),
            F.when(F.col("any_loose"), "### Unlinked Attachments\n\n").otherwise("")).alias("text")),
        F.struct(F.lit(3).alias("part"), F.concat(
            F.when(F.col("any_loose"), "\n").otherwise(""),
            F.lit("### Attachment Details\n\n")).alias("text")))).alias("h")) \
        .select("page_id", "h.part", F.lit(0).cast("long").alias("chunk"), "h.text")
    return heads.unionByName(body)


def prepare_content(contents: DataFrame, listed: DataFrame, details: DataFrame) -> DataFrame:
    """Final page texts as chunks (page_id, part, chunk, text): part 0 is the rewritten text.

    Pages that list no attachments keep their text as it is.
    """
    counted = stage_small(usable(details).join(listed.select("page_id").distinct(), "page_id", "left_semi").select(
        "page_id", "path", "ord", "attachment_id", "api_url", "name", "content_type", "uploaded"), "usable")
    new = stage_small(replace_refs(contents, counted), "contents")
    body = new.select("page_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("chunk"),
                      F.col("content").alias("text"))
    return body.unionByName(section_chunks(new, counted))


def whole_texts(chunks: DataFrame) -> DataFrame:
    """(page_id, text): the chunks of each page in order, for a request that holds one text."""
    ordered = F.array_sort(F.collect_list(F.struct("part", "chunk", "text")))
    return chunks.groupBy("page_id").agg(F.array_join(F.transform(ordered, lambda c: c["text"]), "").alias("text"))


def pending(listed: DataFrame, details: DataFrame) -> DataFrame:
    """(page_id, pending): any listed attachment without a successful upload."""
    state = details.select("page_id", "path", F.col("uploaded").alias("_done"))
    return (listed.join(state, ["page_id", "path"], "left").groupBy("page_id")
            .agg(F.bool_or(~F.coalesce("_done", F.lit(False))).alias("pending")))


def outcomes(attempts: DataFrame, tries: int = fixed.ATTACHMENT_TRIES) -> DataFrame:
    """One row per attachment after at most ``tries`` attempts: success or failure record."""
    done = (attempts.where(F.col("attempt") < tries).groupBy("page_id", "path")
            .agg(F.min(F.when(F.col("success"), F.col("attempt"))).alias("first_ok"),
                 F.max("attempt").alias("last"),
                 F.max_by("error", "attempt").alias("detailed_error")))
    ok = F.col("first_ok").isNotNull()
    return done.select(
        "page_id", "path", ok.alias("uploaded"),
        F.coalesce("first_ok", "last").alias("retry_count"),
        F.when(~ok, F.lit(f"Upload failed after {tries} attempts")).alias("error"),
        F.when(~ok, F.col("detailed_error")).alias("detailed_error"))


def statistics(details: DataFrame, by: str = "space_key") -> DataFrame:
    """Totals per space: uploaded, failed (has a failure time), skipped (neither)."""
    failed = ~F.col("uploaded") & F.col("upload_failed_at").isNotNull()
    return details.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_attachments"),
        F.count_if(F.col("uploaded")).alias("uploaded_attachments"),
        F.count_if(failed).alias("failed_attachments"),
        F.count_if(~F.col("uploaded") & F.col("upload_failed_at").isNull()).alias("skipped_attachments"))
