"""The phases of a migration, composed from the operators. Every phase maps tables to tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import fixed
from pagewright.functions.text import default_content, space_key_or_default
from pagewright.operators import archives, attachments, dom, sync, tree
from pagewright.session import stage_small as stage
from pagewright.sources import files


def extract_zips(archive_files: DataFrame, max_file_size: int = fixed.MAX_FILE_SIZE,
                 max_files: int = fixed.MAX_FILES,
                 max_total_size: int = fixed.MAX_TOTAL_SIZE) -> tuple[DataFrame, DataFrame]:
    """(summary per archive, admitted member rows) of archive files (path, content)."""
    members = files.scan_zip_members(archive_files)
    return (archives.extraction_summary(members, max_file_size, max_files, max_total_size),
            archives.admitted(members, max_file_size, max_files, max_total_size))


def process_input(index_pages: DataFrame, page_files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(space headers, content items) from index pages.

    ``index_pages`` carries (page_id, export, folder, html), one row per exported space;
    ``page_files`` (page_id, href) lists the files next to each index. When several exports
    hold a space key, the latest export name wins. Spaces and links are written once, as
    headers and items read them several times.
    """
    tokens = dom.html_tokens(index_pages)
    found = index_pages.select("page_id", "export", "folder").join(dom.space_metadata(tokens), "page_id", "left")
    spaces = stage(tree.latest_export(found.select(
        space_key_or_default("space_key", "folder").alias("space_key"), "page_id", "export", "folder",
        F.coalesce("space_name", "folder").alias("space_name"), "description")), "spaces")
    owner = spaces.select("page_id", "space_key")
    links = stage(dom.link_paths(tokens).join(owner, "page_id")
                  .select("space_key", "pos", "title", "path", "href", F.col("link_page_id").alias("page_id"),
                          "hierarchy_level"), "links")
    nodes = tree.build_tree(links, staged=True)
    items = tree.convert_items(nodes, page_files.join(owner, "page_id").select("space_key", "href"))
    headers = tree.space_documents(spaces.drop("page_id"), tree.structure_stats(links, nodes), nodes)
    return headers, items


def extract_content(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Items with their markdown; ``pages`` carries (space_key, href, html).

    Every page is converted once; one without content is named by the item that asks for it.
    """
    ident = F.concat_ws("/", "space_key", "href")
    new = dom.converted_pages(pages.select(ident.alias("page_id"), "html")).select(
        F.col("page_id").alias("_id"), F.col("found"), F.col("markdown"))
    asked = F.concat_ws("/", "space_key", F.coalesce("html_page", F.lit("")))
    held = items.select("*", asked.alias("_id"), F.col("html_page").alias("_page"))
    return (held.join(new, "_id", "left")
            .withColumn("md_content", default_content("title", "html_page", F.col("found").isNotNull(),
                                                      dom.or_lost(F.col("_page"))))
            .drop("_id", "_page", "found", "markdown"))


def upload_plan(items: DataFrame, documents: DataFrame, spaces: DataFrame, listed: DataFrame,
                force: bool = False) -> DataFrame:
    """Request rows: action, wave, parent and body of every item, nothing sent.

    The body is a create or an update request, null where nothing is to be sent, and where the
    item waits for its parent's id: merge the outcomes of a wave, then plan the next one.
    """
    have = listed.select("page_id").distinct().withColumn("has_attachments", F.lit(True))
    planned = (sync.with_parent_uuid(sync.sync_action(items, documents, spaces, force).drop("root_path"))
               .join(have, "page_id", "left")
               .withColumn("has_attachments", F.coalesce("has_attachments", F.lit(False))))
    waved = sync.sync_waves(planned).drop("root_path")
    create = F.to_json(sync.document_request())
    update = F.to_json(sync.update_request())
    return waved.withColumn("request", F.when((F.col("action") == "create") & ~F.col("waits_for_parent"), create)
                            .when(F.col("action") == "update", update))


def upload_requests(items: DataFrame, documents: DataFrame, spaces: DataFrame, listed: DataFrame, files: DataFrame,
                    details: DataFrame, contents: DataFrame, outcomes: DataFrame | None = None,
                    force: bool = False) -> DataFrame:
    """All requests that can be sent now: (space_key, path, wave, step, kind, key, request).

    Steps: 0 ``collection`` for spaces without a collection id, whose items wait for it;
    1 ``document``, a create or update; 2 ``attachment`` for each listed file not yet uploaded
    of a document that is there (``key`` is its path); 3 ``update`` of documents created in this
    run, once all their attachments have an outcome, with the text that links them.

    ``outcomes`` (space_key, path, page_uuid) are documents created in this run. ``files``
    (page_id, path, size) exist on disk, ``details`` are outcomes of attachments and
    ``contents`` (page_id, content) the texts. A listed file that does not exist gives no
    request (``attachments.missing_files`` has it) and is not waited for. Items, plan, ``details``,
    listed files with what ``files`` and ``details`` tell of them, and their pages are written once, as several passes
    read them. Repeated rows of
    ``listed`` and ``files`` count once. Attachments meet their document by page id, one row
    each; only the text of a second update is put together, since the request holds it whole.
    """
    key = ["space_key", "path"]
    names = [c for c in items.columns if c != "_fresh"]
    if outcomes is None:
        held, known = items.select(*names, F.lit(False).alias("_fresh")), documents.select("id")
    else:
        made = outcomes.where("page_uuid IS NOT NULL").groupBy(*key).agg(F.min("page_uuid").alias("_uuid"))
        fresh = F.col("_uuid").isNotNull()
        held = (items.select(*names).join(made, key, "left").withColumns({
            "page_uuid": F.coalesce("_uuid", "page_uuid"), "created": F.col("created") | fresh, "_fresh": fresh}).drop("_uuid"))
        known = documents.select("id").union(made.select("_uuid")).distinct()
    held = stage(held, "items")
    homes = spaces.where("collection_id IS NOT NULL")
    opened = held.join(homes.select("space_key"), "space_key", "left_semi")
    details = stage(details.select("page_id", "path", "ord", "attachment_id", "api_url", "name", "content_type", "uploaded"), "details")
    # whether each listed file exists, was uploaded and was tried: three shuffles by path, and no more for what follows
    sizes = files.select("page_id", "path", "size").dropDuplicates(["page_id", "path"]).withColumn("there", F.lit(True))
    state = details.groupBy("page_id", "path").agg(F.bool_or("uploaded").alias("sent"), F.lit(True).alias("tried"))
    joined = stage(listed.select("page_id", "path").distinct().join(sizes, ["page_id", "path"], "left")
                   .join(state, ["page_id", "path"], "left"), "files")
    listed, found = stage(joined.select("page_id").distinct(), "listed"), joined.where("there")
    plan = stage(upload_plan(opened, known, homes, listed, force), "plan")
    where = ["space_key", "path", "wave"]
    out = ["space_key", "path", "wave", "step", "kind", "key", "request"]

    def rows(df: DataFrame, step: int, kind: str) -> DataFrame:
        return df.withColumns({"step": F.lit(step), "kind": F.lit(kind)}).select(*out)

    none = F.lit(None).cast("string")
    collections = sync.collection_payload(spaces.where("collection_id IS NULL"), items).select(
        "space_key", F.lit(None).cast("array<string>").alias("path"), F.lit(0).alias("wave"), none.alias("key"),
        F.to_json("request").alias("request"))
    sent = plan.where(F.col("request").isNotNull() & ~F.col("_fresh")).withColumn("key", none)
    there = plan.where(F.col("action").isin("skip", "update") & F.col("exists_remotely"))
    owner = there.select(*where, F.col("page_id"), F.col("page_uuid").alias("document_id"))

    open_files = found.where(~F.coalesce("sent", F.lit(False))).select("page_id", "path", "size")
    records = (attachments.inventory(open_files.join(owner.withColumnRenamed("path", "_path"), "page_id"))
               .withColumnsRenamed({"path": "key", "_path": "path"})
               .withColumn("request", F.to_json(sync.attachment_request())))

    waiting = found.where("tried IS NULL").select("page_id")
    ready = (there.where("_fresh AND has_attachments").join(waiting.distinct(), "page_id", "left_anti")
             .select(*where, "page_id", "page_uuid", "title", "md_content"))
    wanted = [t.join(ready.select("page_id"), "page_id", "left_semi") for t in (contents, listed, details)]
    texts = attachments.whole_texts(attachments.prepare_content(*wanted))
    again = (ready.join(texts, "page_id").where(sync.content_update_needed("md_content", F.col("text")))
             .withColumn("md_content", F.col("text"))
             .withColumns({"key": none, "request": F.to_json(sync.update_request())}))
    return (rows(collections, 0, "collection").unionByName(rows(sent, 1, "document"))
            .unionByName(rows(records, 2, "attachment")).unionByName(rows(again, 3, "update")))
