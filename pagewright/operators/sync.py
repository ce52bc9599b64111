"""Synchronisation with a remote knowledge base as tables.

Requests are rows of a plan, remote state is a snapshot, outcomes come back as attempts.
Nothing here talks to a network.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import fixed
from pagewright.functions.text import col, is_blank, response_class, title_from_html
from pagewright.operators.numbering import number_rows, running_sum
from pagewright.operators.tree import KEY, closing, intervals, opening
from pagewright.session import stage, unstage

# ---------------------------------------------------------------- snapshots


def newest_first(table: DataFrame, limit: int = 25, offset: int = 0) -> DataFrame:
    """A page of collections or documents, newest update first."""
    return table.orderBy(F.desc("updated_at"), "id").offset(offset).limit(limit)


def list_documents(documents: DataFrame, collection_id: str, limit: int = 25, offset: int = 0) -> DataFrame:
    return newest_first(documents.where(F.col("collection_id") == collection_id), limit, offset)


def get_by_id(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Point lookups for a table of ids."""
    return table.join(ids.select("id").distinct(), "id", "left_semi")


def search_documents(documents: DataFrame, query: str, collection_id: str | None = None,
                     limit: int = 25) -> DataFrame:
    """Documents by number of query words they hold, then id."""
    words = list(dict.fromkeys(query.lower().split()))
    text = F.lower(F.concat_ws(" ", "title", "text"))
    if collection_id is not None:
        documents = documents.where(F.col("collection_id") == collection_id)
    scored = documents.withColumn("score", sum(
        (text.contains(w).cast("int") for w in words), F.lit(0)))
    return scored.where("score > 0").orderBy(F.desc("score"), "id").limit(limit)


# ---------------------------------------------------------------- collections

def ambiguous_collections(collections: DataFrame) -> DataFrame:
    """Collections that share their name, numbered as choices, newest update first."""
    shared = (collections.groupBy("name").agg(F.count(F.lit(1)).alias("matches"))
              .where("matches > 1"))
    newest = -F.unix_micros(F.col("updated_at").cast("timestamp"))
    found = collections.join(shared, "name").withColumn("_newest", newest)
    return (number_rows(found, ["name"], ["_newest", "id"], "choice")
            .withColumn("documents", F.coalesce(F.col("document_count").cast("string"), F.lit("unknown")))
            .drop("_newest"))


def match_collections(spaces: DataFrame, collections: DataFrame) -> DataFrame:
    """The collection of each space: stored id if it still has the name, else by exact name,
    else new. ``choice`` picks among several of one name; without it the space is ambiguous.
    """
    by_id = collections.select(F.col("id").alias("_id"), F.col("name").alias("_stored_name"))
    by_name = collections.groupBy(F.col("name").alias("space_name")).agg(
        F.count(F.lit(1)).alias("_matches"), F.min("id").alias("_only"))
    chosen = ambiguous_collections(collections).select(
        F.col("name").alias("space_name"), "choice", F.col("id").alias("_chosen"))
    valid = F.coalesce(F.col("_stored_name") == F.col("space_name"), F.lit(False))
    # spaces without a stored id get a key of their own so that they do not meet in one task
    asked = F.coalesce("stored_id", F.concat(F.lit("\u0000"), F.col("space_key")))
    return (spaces.withColumn("_id", asked).join(by_id, "_id", "left").drop("_id").join(by_name, "space_name", "left")
            .join(chosen, ["space_name", "choice"], "left")
            .withColumn("decision", F.when(valid, "stored").when(F.col("_matches").isNull(), "create")
                        .when(F.col("_matches") == 1, "found")
                        .when(F.col("_chosen").isNotNull(), "chosen").otherwise("ambiguous"))
            .withColumn("collection_id", F.when(valid, F.col("stored_id"))
                        .when(F.col("decision") == "found", F.col("_only"))
                        .when(F.col("decision") == "chosen", F.col("_chosen")))
            .drop("_stored_name", "_matches", "_only", "_chosen"))


# ---------------------------------------------------------------- actions

def with_existence(items: DataFrame, documents: DataFrame, spaces: DataFrame) -> DataFrame:
    """Add ``exists_remotely``: the item's uuid, unless blank or the collection id, is known.

    Items without a uuid get a key of their own so that they do not meet in one task.
    """
    unknown = F.concat(F.lit("\u0000"), F.xxhash64(*KEY).cast("string"))
    asked = F.when(~is_blank("page_uuid") & ~F.coalesce(
        F.col("page_uuid") == F.col("collection_id"), F.lit(False)), F.col("page_uuid"))
    known = documents.select(F.col("id").alias("_id"), F.lit(True).alias("exists_remotely"))
    return (items.join(spaces.select("space_key", "collection_id"), "space_key", "left")
            .withColumn("_id", F.coalesce(asked, unknown))
            .join(known, "_id", "left").drop("_id")
            .withColumn("exists_remotely", F.coalesce("exists_remotely", F.lit(False))))


def root_pages(items: DataFrame) -> DataFrame:
    """(space_key, path) of the first root item of each space: its page becomes the collection."""
    return (items.where(F.size("path") == 1).groupBy("space_key")
            .agg(F.min_by("path", "pos").alias("root_path")))


def sync_action(items: DataFrame, documents: DataFrame, spaces: DataFrame,
                force: bool = False) -> DataFrame:
    """Add ``action``: space_root, update, skip or create."""
    made, exists = F.col("created"), F.col("exists_remotely")
    if force:
        rest = F.when(made & exists, "update")
    else:
        rest = F.when(made & (exists | (F.coalesce("page_uuid", F.lit("")) == "")), "skip")
    is_root = F.coalesce(F.col("path") == F.col("root_path"), F.lit(False))
    return (with_existence(items, documents, spaces)
            .join(root_pages(items), "space_key", "left")
            .withColumn("action", F.when(is_root, "space_root").otherwise(
                F.coalesce(rest, F.lit("create")))))


def under_root() -> Column:
    """Whether an item lies below the space page (needs ``root_path``)."""
    return F.coalesce(F.get("path", F.lit(0)) == F.get("root_path", F.lit(0)), F.lit(False))


def sync_waves(items: DataFrame) -> DataFrame:
    """Parents before children: the space page is wave 0, its children are top level.

    Run the waves in order; sort by (wave, pos) where one sequence is wanted.
    """
    return (items.join(root_pages(items), "space_key", "left")
            .withColumn("wave", F.size("path") - under_root().cast("int")))


def blocked_parents(items: DataFrame, failed: DataFrame) -> DataFrame:
    """Distinct parent paths at or below a failed create: in pre-order, those at which more
    failed subtrees have opened than closed."""
    none = F.lit(None).cast("array<string>")
    asked = (items.where(F.size("path") > 1).select("space_key", "parent_path").distinct()
             .select("space_key", "parent_path", opening("parent_path").alias("_at"), F.lit(1).alias("_tie"), F.lit(0).alias("_v")))
    edge = lambda at, step: failed.select(*KEY).distinct().select(
        "space_key", none.alias("parent_path"), at("path").alias("_at"), F.lit(0).alias("_tie"), F.lit(step).alias("_v"))
    walked = running_sum(asked.unionByName(edge(opening, 1)).unionByName(edge(closing, -1)), ["space_key"], ["_at", "_tie"], "_v", "_open")
    return walked.where("parent_path IS NOT NULL AND _open > 0").select("space_key", "parent_path")


def attempted_items(items: DataFrame, failed: DataFrame) -> DataFrame:
    """Items that are attempted: all but the descendants of failed creates."""
    return items.join(blocked_parents(items, failed), ["space_key", "parent_path"], "left_anti")


def with_parent_uuid(items: DataFrame) -> DataFrame:
    """Parent document id; none for roots and for the children of the space page.

    Where ``action`` is planned, an id that a parent had before it is created anew does not
    count: its children have no parent id yet and ``waits_for_parent``. Plan them again when
    the outcomes of the wave before are merged.
    """
    planned = "action" in items.columns
    new = F.coalesce(F.col("action") == "create", F.lit(False)) if planned else F.lit(False)
    up = items.select("space_key", F.col("path").alias("parent_path"), F.col("page_uuid").alias("_up"), new.alias("_new"))
    top = (F.size("path") == 1) | (F.col("parent_path") == F.col("root_path"))
    waits = F.coalesce(~top & F.col("_new"), F.lit(False))
    out = (items.drop("parent_uuid").join(root_pages(items), "space_key", "left")
           .join(up, ["space_key", "parent_path"], "left")
           .withColumn("parent_uuid", F.when(~top & ~waits, F.col("_up"))))
    if planned:
        out = out.withColumn("waits_for_parent", waits & new)
    return out.drop("_up", "_new", "root_path")


# ---------------------------------------------------------------- payloads

def _or_stub(text, stub: Column) -> Column:
    return F.when(is_blank(text), stub).otherwise(col(text))


def _titled(stub: str) -> Column:
    return F.concat(F.lit("# "), F.col("title"), F.lit("\n\n" + stub))


def collection_payload(spaces: DataFrame, items: DataFrame, legacy: bool = False) -> DataFrame:
    """Create request per space; the root page is the description if it bears the space's name.

    The legacy request has a visibility field in place of the icon.
    """
    first = items.where(F.size("path") == 1).groupBy("space_key").agg(
        F.min_by(F.struct("title", "md_content"), "pos").alias("_root"))
    content = F.when((F.col("_root.title") == F.col("space_name")) & ~is_blank("_root.md_content"),
                     F.col("_root.md_content"))
    last = F.lit(False).alias("private") if legacy else F.lit(fixed.COLLECTION_ICON).alias("icon")
    body = F.struct(
        F.col("space_name").alias("name"),
        F.coalesce(content, F.concat(F.lit(fixed.IMPORTED_FROM), F.col("space_key"))).alias("description"),
        F.lit(fixed.COLLECTION_COLOR).alias("color"), last)
    return spaces.join(first, "space_key", "left").select("space_key", body.alias("request"))


def document_text(has_attachments, md_content, item_type) -> Column:
    """Text a document is created with."""
    return (F.when(col(has_attachments), _titled(fixed.LOADING_STUB))
            .otherwise(_or_stub(md_content, F.when(
                col(item_type) == "collection", _titled(fixed.SECTION_STUB))
                .otherwise(_titled(fixed.NO_CONTENT_STUB)))))


def document_request() -> Column:
    """Create request of an item; null fields vanish in ``to_json``."""
    return F.struct(
        "title", document_text("has_attachments", "md_content", "type").alias("text"),
        F.col("collection_id").alias("collectionId"), F.lit(True).alias("publish"),
        F.col("parent_uuid").alias("parentDocumentId"))


def update_request() -> Column:
    return F.struct(F.col("page_uuid").alias("id"),
                    _or_stub("md_content", _titled(fixed.NO_CONTENT_STUB)).alias("text"),
                    F.lit(True).alias("publish"))


def document_payload(items: DataFrame) -> DataFrame:
    return items.select(*KEY, document_request().alias("request"))


def update_payload(items: DataFrame) -> DataFrame:
    return items.select(*KEY, update_request().alias("request"))


def partial_update_payload(documents: DataFrame) -> DataFrame:
    """Legacy update: only the fields that are given (id, title, text) are sent."""
    return documents.select("id", F.to_json(F.struct("id", "title", "text")).alias("request"))


def content_update_needed(original, rewritten) -> Column:
    """After attachments were sent: the text changed, or there is any text to send."""
    o = F.coalesce(col(original), F.lit(""))
    return ~col(rewritten).eqNullSafe(o) | (o != "")


def attachment_request() -> Column:
    """Record request of an attachment of a document."""
    return F.struct("name", F.col("mime_type").alias("contentType"), F.col("size_bytes").alias("size"),
                    F.col("document_id").alias("documentId"))


def attachment_payload(files: DataFrame, base_url: str) -> DataFrame:
    """Attachment record request, and the download URL its id will have."""
    body = attachment_request()
    url = F.concat(F.lit(f"{base_url}/api/attachments.redirect?id="), F.col("attachment_id"))
    return files.select("page_id", "path", body.alias("request"), url.alias("api_url"))


def page_upload_plan(pages: DataFrame, collection_id: str, outcomes: DataFrame | None = None) -> DataFrame:
    """One flat create per HTML page: title from the page, raw HTML as text, no parent."""
    body = F.struct(title_from_html("html", "url").alias("title"), F.col("html").alias("text"),
                    F.lit(collection_id).alias("collectionId"), F.lit(True).alias("publish"))
    plan = pages.select("page_id", body.alias("request"))
    return plan if outcomes is None else plan.join(outcomes, "page_id", "left")


# ---------------------------------------------------------------- retries

def retry_schedule(attempts: DataFrame, jitter: Column | float = 0.5) -> DataFrame:
    """Wait before the next attempt, in seconds; null where no further attempt follows.

    Rate limits back off exponentially with jitter up to a cap, but at least as long as the
    server asks. Network errors wait a little longer each time. The jitter is an input.
    """
    n = F.col("attempt")
    jitter = jitter if isinstance(jitter, Column) else F.lit(float(jitter))
    backoff = F.least(F.pow(F.lit(2.0), n) + jitter, F.lit(fixed.MAX_DELAY))
    limited = F.greatest(backoff, F.coalesce("retry_after", F.lit(0.0)))
    network = F.least(n + F.lit(1.0), F.lit(fixed.MAX_NETWORK_DELAY))
    more = n < fixed.MAX_RETRIES
    return attempts.withColumn("delay", F.when(more & F.col("network_error"), network)
                               .when(more & (F.col("status_code") == 429), limited))


def attachment_wait(attempt) -> Column:
    """Wait before a repeated attachment upload: 4 and 8 seconds."""
    n = col(attempt)
    return F.when(n > 0, F.pow(F.lit(2.0), n) * 2).otherwise(0.0)


def attachment_record_wait(retry) -> Column:
    """Wait before repeating a rate limited attachment record: 2, 4 and 8 seconds."""
    return F.pow(F.lit(2.0), col(retry)) * 2


def is_final() -> Column:
    """Attempts that end a request: any response but a rate limit."""
    return ~F.col("network_error") & (F.col("status_code") != 429)


def live_attempts(attempts: DataFrame) -> DataFrame:
    """Attempts up to the first final one. A request holds at most six attempts."""
    w = Window.partitionBy("request_id").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    over = F.coalesce(F.max(F.coalesce(is_final(), F.lit(False))).over(w), F.lit(False))
    return attempts.withColumn("_over", over).where("not _over").drop("_over")


def retry_outcome(attempts: DataFrame) -> DataFrame:
    """Per request: succeeded, error, rate_limited, network_error or open.

    One aggregation over all attempts: those after the first final one cannot win.
    """
    final = F.coalesce(is_final(), F.lit(False))
    stats = attempts.groupBy("request_id").agg(
        F.min(F.when(final, F.struct("attempt", "status_code"))).alias("final"),
        F.max("attempt").alias("last"),
        F.max_by("network_error", "attempt").alias("net"))
    spent = F.col("last") >= fixed.MAX_RETRIES
    return stats.select(
        "request_id",
        F.when(F.col("final.status_code") == 200, "succeeded").when(F.col("final").isNotNull(), "error")
        .when(spent & F.col("net"), "network_error").when(spent, "rate_limited")
        .otherwise("open").alias("outcome"),
        (F.coalesce("final.attempt", "last") + 1).alias("attempts"),
        F.col("final.status_code").alias("status_code"))


def error_action(attempts: DataFrame, max_retries: int = fixed.MAX_RETRIES) -> DataFrame:
    """Documented policy: rate limits retry, server errors retry up to a limit, others skip."""
    s = F.col("status_code")
    return attempts.withColumn("error_action", F.when(s == 429, "retry")
                               .when(s.isin(500, 502, 503), F.when(
                                   F.col("attempt") < max_retries, "retry").otherwise("fail"))
                               .when(response_class("status_code") == "ok", "none")
                               .otherwise("skip"))


def item_errors(failures: DataFrame, by: str = "item") -> DataFrame:
    """Error records with ``retry_count`` = failures of the item before this one."""
    return (number_rows(failures, [by], ["seq"])
            .withColumn("retry_count", (F.col("rn") - 1).cast("long")).drop("rn"))


def mark_failed(items: DataFrame, errors: DataFrame) -> DataFrame:
    """Items with any error record are not created."""
    bad = errors.select(*KEY).distinct().withColumn("_bad", F.lit(True))
    return (items.join(bad, KEY, "left")
            .withColumn("created", F.col("created") & F.col("_bad").isNull()).drop("_bad"))


def collection_errors(failures: DataFrame) -> DataFrame:
    """Collection-level errors per space with their count; ``collection_error_records`` has the
    records themselves."""
    return failures.groupBy("space_key", "error").agg(
        F.count(F.lit(1)).alias("times"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


def collection_error_records(failures: DataFrame) -> DataFrame:
    """Every collection-level error record as a row, with ``retry_count`` = those of its space before."""
    return item_errors(failures, "space_key")


# ---------------------------------------------------------------- state

def merge_state(items: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Write back uuids and created flags of finished items."""
    new = outcomes.select(*KEY, F.col("page_uuid").alias("_uuid"), F.col("parent_uuid").alias("_parent"),
                          F.col("created").alias("_created"))
    return (items.join(new, KEY, "left")
            .withColumn("parent_uuid", F.when(F.col("_created"), F.col("_parent")).otherwise(F.col("parent_uuid")))
            .withColumn("page_uuid", F.coalesce("_uuid", "page_uuid"))
            .withColumn("created", F.coalesce("_created", "created"))
            .drop("_uuid", "_parent", "_created"))


def run_waves(items: DataFrame, spaces: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Items after all waves were run: merged state and ``upload_state``.

    ``outcomes`` (space_key, path, page_uuid, created) tells what each request came to, one row
    per item at most; it is a table, so a run can be repeated. One wave a turn: the requests of a
    wave are the items whose parent is there (top-level items need none), their outcomes give the
    parents of the next wave. A turn reads its wave and the parents just found, and writes only
    what it found; the loop ends with the first wave that has no request.

    The first root item of a space with a collection becomes created under the collection's id.
    ``upload_state``: ``created``; ``failed`` (its own request failed); ``pending`` (requested, no
    outcome yet); ``not attempted`` (an ancestor is not there). An item that was created
    before keeps its state where an update of it failed, and its children still run. Items are
    unique by space and path; outcomes of unknown items are ignored.
    """
    waved = (sync_waves(items).withColumn("_root", F.coalesce(F.col("path") == F.col("root_path"), F.lit(False)))
             .select(*KEY, "parent_path", "wave", "_root", "page_uuid", "created",
                     ((F.size("path") == 1) | F.coalesce(F.col("parent_path") == F.col("root_path"), F.lit(False))).alias("_top")))
    waved = stage(waved, "waves")
    came = stage(outcomes.select(*KEY, F.col("page_uuid").alias("_uuid"), F.col("created").alias("_ok")), "outcomes")
    homes = spaces.where("collection_id IS NOT NULL").select("space_key", F.col("collection_id").alias("_home"))

    def settled(requests: DataFrame) -> DataFrame:
        """Requests with the outcome they had."""
        before = F.coalesce("created", F.lit(False)) & F.col("page_uuid").isNotNull()
        state = (F.when(F.coalesce("_ok", F.lit(False)) | (F.col("_ok").isNull() & F.coalesce("created", F.lit(False))), "created")
                 .when(F.col("_ok").isNull(), "pending").when(before, "created").otherwise("failed"))
        return (requests.join(came, KEY, "left").withColumn("upload_state", state)
                .select(*KEY, F.coalesce(F.when(F.col("_ok"), F.col("_uuid")), "page_uuid").alias("page_uuid"), "_up", "upload_state"))

    none = F.lit(None).cast("string")
    root = (waved.where("_root").join(homes, "space_key", "left")
            .select(*KEY, F.coalesce("_home", "page_uuid").alias("page_uuid"), none.alias("_up"),
                    F.when(F.col("_home").isNotNull() | F.coalesce("created", F.lit(False)), "created").otherwise("pending").alias("upload_state")))
    turns = [stage(root, "turn")]
    wave = 1
    while True:
        there = turns[-1].where("upload_state = 'created' AND page_uuid IS NOT NULL").select(
            "space_key", F.col("path").alias("parent_path"), F.col("page_uuid").alias("_up"))
        level = waved.where((F.col("wave") == wave) & ~F.col("_root"))
        ready = level.where("NOT _top").join(there, ["space_key", "parent_path"])
        if wave == 1:
            ready = ready.unionByName(level.where("_top").withColumn("_up", none))
        turn = stage(settled(ready), "turn")
        if turn.isEmpty():
            unstage(turn)
            break
        turns.append(turn)
        wave += 1
    done = reduce(DataFrame.unionByName, turns).withColumnsRenamed({"page_uuid": "_uuid"})
    return (items.drop("upload_state").join(done, KEY, "left")
            .withColumn("upload_state", F.coalesce("upload_state", F.lit("not attempted")))
            .withColumn("parent_uuid", F.when(F.col("upload_state") == "created", F.col("_up")).otherwise(F.col("parent_uuid")))
            .withColumn("page_uuid", F.coalesce("_uuid", "page_uuid"))
            .withColumn("created", F.when(F.col("upload_state").isin("created", "failed"), F.col("upload_state") == "created")
                        .otherwise(F.coalesce("created", F.lit(False))))
            .drop("_uuid", "_up"))


def reset_state(items: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Items of the given spaces as before any upload."""
    hit = F.lit(True) if keys is None else F.col("space_key").isin(keys)
    none = F.lit(None).cast("string")
    return items.withColumns({
        "created": F.when(hit, False).otherwise(F.col("created")),
        "page_uuid": F.when(hit, none).otherwise(F.col("page_uuid")),
        "parent_uuid": F.when(hit, none).otherwise(F.col("parent_uuid"))})


def reset_details(details: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Attachment details that survive a reset."""
    return details.where(F.lit(False) if keys is None else ~F.col("space_key").isin(keys))


def reset_stats(spaces: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Space headers without their upload fields."""
    hit = F.lit(True) if keys is None else F.col("space_key").isin(keys)
    return spaces.withColumns({c: F.when(~hit, F.col(c)) for c in
                               ("uploaded_at", "upload_successful", "collection_id") if c in spaces.columns})


def resume_batch(items: DataFrame, state: DataFrame) -> DataFrame:
    """Only items without a finished outcome."""
    return items.join(state.where("created").select(*KEY), KEY, "left_anti")


# ---------------------------------------------------------------- documented extras

def batch_assign(plan: DataFrame, size: int = 10) -> DataFrame:
    """Batches of ``size`` documents within each wave of a space, by position, then path."""
    return (number_rows(plan, ["space_key", "wave"], ["pos", "path"])
            .withColumn("batch", F.floor((F.col("rn") - 1) / size).cast("long")).drop("rn"))


def dry_run_report(plan: DataFrame) -> DataFrame:
    """Planned work by space and action; nothing is sent."""
    return plan.groupBy("space_key", "action").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("attachments").alias("attachments"),
        F.sum("missing_files").alias("missing_files"))


# Checks of an item before anything is sent: name, condition, detail. A table, so callers can add
# to it; conditions see the item's columns, ``_parent`` (its parent is an item), ``_times`` (items
# of its path) and ``_home`` (its space has a collection or a name to make one by).
CHECKS = {
    "blank title": (lambda: is_blank("title"), lambda: F.lit(None).cast("string")),
    "long title": (lambda: F.length("title") > fixed.MAX_TITLE, lambda: F.length("title").cast("string")),
    "orphan": (lambda: (F.size("path") > 1) & ~F.col("_parent"), lambda: F.element_at("parent_path", -1)),
    "repeated path": (lambda: F.col("_times") > 1, lambda: F.col("_times").cast("string")),
    "page without file": (lambda: (F.col("type") == "page") & F.col("html_page").isNull(), lambda: F.col("href")),
    "unknown space": (lambda: ~F.col("_home"), lambda: F.col("space_key")),
}


def dry_run_violations(items: DataFrame, spaces: DataFrame, listed: DataFrame, files: DataFrame,
                       checks: dict = CHECKS) -> DataFrame:
    """One row (space_key, path, rule, detail) for each check that an item fails, and one for each
    listed attachment (page_id, path) of an item that is no file; nothing is sent.

    All checks run in one pass over the items, once these know their parent, their namesakes
    and their space; an item gives at most one row a check, so the array is bounded by the
    table of checks. A check whose condition is null holds. Items of no space or a null path
    are checked like others; attachments of unknown pages are not listed.
    """
    slim = items.select(*KEY, "parent_path", "title", "type", "href", "html_page", "page_id")
    paths = slim.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_times"))
    up = paths.select("space_key", F.col("path").alias("parent_path"), F.lit(True).alias("_up"))
    homes = spaces.where(~is_blank("space_name") | F.col("collection_id").isNotNull()).select("space_key", F.lit(True).alias("_at")).distinct()
    known = (slim.join(paths, KEY, "left").join(up, ["space_key", "parent_path"], "left").join(homes, "space_key", "left")
             .withColumns({"_parent": F.col("_up").isNotNull(), "_home": F.col("_at").isNotNull()}))
    rows = F.array(*[F.when(failed(), F.struct(F.lit(rule).alias("rule"), detail().alias("detail")))
                     for rule, (failed, detail) in checks.items()])
    found = (known.select(*KEY, F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
             .select(*KEY, "r.rule", "r.detail"))
    lost = listed.select("page_id", F.col("path").alias("file")).distinct().join(
        files.select("page_id", F.col("path").alias("file")), ["page_id", "file"], "left_anti")
    return found.unionByName(slim.select(*KEY, "page_id").join(lost, "page_id").select(
        *KEY, F.lit("missing file").alias("rule"), F.col("file").alias("detail")))


def work_estimate(plan: DataFrame, batch: int = 10, per_minute: int = 60) -> DataFrame:
    """Per space: requests by kind, batches, waves and the minutes they take at least at
    ``per_minute`` requests. ``plan`` carries action, path, attachments (listed and not there yet)
    and bytes; an attachment takes two requests, a record and its file."""
    count = lambda kind: F.count_if(F.col("action") == kind)
    sums = plan.groupBy("space_key").agg(
        count("create").alias("creates"), count("update").alias("updates"), count("skip").alias("skips"),
        F.sum(F.coalesce("attachments", F.lit(0))).cast("long").alias("attachments"),
        F.sum(F.coalesce("bytes", F.lit(0))).cast("long").alias("bytes"), F.max(F.size("path")).alias("waves"))
    documents = F.col("creates") + F.col("updates")
    return (sums.withColumn("requests", documents + 2 * F.col("attachments"))
            .withColumn("batches", F.ceil(documents / batch).cast("long"))
            .withColumn("minutes", F.ceil(F.col("requests") / per_minute).cast("long")))


def verify_upload(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Items against remote documents by id: missing, extra, changed or equal."""
    mine = items.where("page_uuid is not null").select(
        F.col("page_uuid").alias("id"), F.sha2("md_content", 256).alias("_mine"), F.lit(True).alias("_here"))
    theirs = documents.select("id", F.sha2("text", 256).alias("_theirs"), F.lit(True).alias("_there"))
    return (mine.join(theirs, "id", "full_outer")
            .withColumn("verdict", F.when(F.col("_there").isNull(), "missing")
                        .when(F.col("_here").isNull(), "extra")
                        .when(F.col("_mine").eqNullSafe(F.col("_theirs")), "equal").otherwise("changed"))
            .drop("_mine", "_theirs", "_here", "_there"))


def verify_tree(items: DataFrame, documents: DataFrame, listed: DataFrame, details: DataFrame) -> DataFrame:
    """Content, place and attachments of every item against the remote tree, and of every remote
    document without an item.

    ``documents`` carries (id, parent_id, text), ``listed`` (page_id, path) what items list and
    ``details`` (page_id, path, uploaded) what arrived. ``content`` is equal, changed, missing,
    not uploaded or extra; ``moved``: the document is there, but not below the document of the
    item's parent; ``missing_files`` counts listed attachments that did not arrive.
    ``below`` counts differing items in the subtree, so a reader opens only subtrees where it is
    not 0; it is the difference of two running counts in pre-order. The space page
    is its collection and is not compared. Each side is joined once; missing ids never meet.
    """
    home = F.coalesce(F.col("path") == F.col("root_path"), F.lit(False))
    placed = with_parent_uuid(items).join(root_pages(items), "space_key", "left").where(~home)
    files = (listed.select("page_id", "path").distinct()
             .join(details.where("uploaded").select("page_id", "path", F.lit(True).alias("_done")).distinct(), ["page_id", "path"], "left")
             .groupBy("page_id").agg(F.count_if(F.col("_done").isNull()).alias("_lost")))
    mine = placed.join(files, "page_id", "left").select(
        *KEY, F.col("page_uuid").alias("id"), F.col("parent_uuid").alias("_parent"), F.sha2("md_content", 256).alias("_mine"),
        F.coalesce("_lost", F.lit(0)).alias("missing_files"), F.lit(True).alias("_here"))
    theirs = documents.select("id", F.col("parent_id").alias("_under"), F.sha2("text", 256).alias("_theirs"), F.lit(True).alias("_there"))
    here, there = F.col("_here").isNotNull(), F.col("_there").isNotNull()
    content = (F.when(~here, "extra").when(F.col("id").isNull(), "not uploaded").when(~there, "missing")
               .when(F.col("_mine").eqNullSafe(F.col("_theirs")), "equal").otherwise("changed"))
    compared = stage(mine.join(theirs, "id", "full_outer").select(
        *KEY, "id", content.alias("content"), (here & there & ~F.col("_parent").eqNullSafe(F.col("_under"))).alias("moved"),
        F.coalesce("missing_files", F.lit(0)).cast("long").alias("missing_files")), "compared")
    differs = (F.col("content") != "equal") | F.col("moved") | (F.col("missing_files") > 0)
    below = (intervals(compared.where(F.col("path").isNotNull()), F.coalesce(differs, F.lit(False)).cast("int"))
             .select(*KEY, (F.col("last") - F.col("first") + 1).alias("below")))
    return compared.join(below, KEY, "left").withColumn("below", F.coalesce("below", F.lit(0)))


def rollback_plan(created: DataFrame) -> DataFrame:
    """Deletions: attachments, then documents, then collections; each newest first."""
    rank = F.when(F.col("kind") == "attachment", 1).when(F.col("kind") == "document", 2).otherwise(3)
    return created.withColumn("rank", rank).orderBy("rank", F.desc("seq"))


def skip_attachments(plan: DataFrame) -> DataFrame:
    return plan.where("kind <> 'attachment'")


def nav_mapping(nodes: DataFrame) -> DataFrame:
    """Navigation node → collection, page → document, with the source page id."""
    return nodes.select("space_key", "path", "title", "page_id", F.when(
        F.col("type") == "page", "document").otherwise("collection").alias("target"))


def cross_reference_update(contents: DataFrame, uuids: DataFrame, base_url: str) -> DataFrame:
    """Links to known pages of the same space rewritten to their document URLs.

    The links of a page are bounded by its text, so they may be gathered for the fold.
    """
    link = r"\]\(([^()\s]+\.html)\)"
    links = contents.select("space_key", "page_id", F.explode(F.array_distinct(
        F.regexp_extract_all("content", F.lit(link), F.lit(1)))).alias("href"))
    found = (links.join(uuids.select("space_key", "href", "page_uuid"), ["space_key", "href"])
             .groupBy("space_key", "page_id").agg(F.array_sort(F.collect_list(F.struct("href", "page_uuid"))).alias("_l")))
    new = F.aggregate("_l", F.col("content"), lambda c, x: F.replace(
        c, F.concat(F.lit("]("), x["href"], F.lit(")")),
        F.concat(F.lit(f"]({base_url}/doc/"), x["page_uuid"], F.lit(")"))))
    return (contents.join(found, ["space_key", "page_id"], "left")
            .withColumn("content", F.coalesce(new, F.col("content"))).drop("_l"))


def link_validation(links: DataFrame, files: DataFrame) -> DataFrame:
    """Links to pages that do not exist."""
    return links.join(files.select("space_key", "href").distinct(), ["space_key", "href"], "left_anti")
