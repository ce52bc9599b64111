"""Column functions on names, paths and short strings (JVM-side only)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import fixed


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c) -> Column:
    """Drop leading and trailing white space of any kind."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+\z", "")


def squeeze(c) -> Column:
    """Collapse runs of white space to one space and strip."""
    return strip(F.regexp_replace(col(c), r"(?U)\s+", " "))


def is_blank(c) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def group(c, pattern: str, idx: int = 1) -> Column:
    """Capture group of the first match, null where there is none."""
    c = col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, idx))


def literal_replace(c, old, new) -> Column:
    return F.replace(col(c), col(old) if isinstance(old, str) else old, new)


def path_join(parts, sep: str = " → ") -> Column:
    """A path as one label."""
    return F.array_join(col(parts), sep)


def basename(path) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def extension(name) -> Column:
    """Lower-cased last suffix with its dot; empty when there is none (``.x`` has none)."""
    return F.lower(F.regexp_extract(basename(name), r"(?s)[^.].*?(\.[^.]+)$", 1))


def stem(name) -> Column:
    return F.regexp_replace(basename(name), r"(?s)(?<=[^.])\.[^.]+$", "")


# ---------------------------------------------------------------- archives

def zip_folder_name(path) -> Column:
    """Folder name for an archive: short prefix, no blanks, only letters, digits, - and _."""
    name = F.regexp_replace(stem(path), r"\.html$", "")
    name = F.replace(name, F.lit(fixed.EXPORT_PREFIX), F.lit(fixed.EXPORT_SHORT_PREFIX))
    return F.regexp_replace(F.replace(name, F.lit(" "), F.lit("-")), r"[^\p{L}\p{N}_-]", "")


def zip_member_guard(member, file_size, max_file_size: int = fixed.MAX_FILE_SIZE) -> Column:
    """Why a member is blocked, in order of precedence; null when it is admitted."""
    member, file_size = col(member), col(file_size)
    return (F.when(member.startswith("/") | member.contains(".."), "suspicious path")
            .when(file_size > max_file_size, "file too large")
            .when(F.length(member) > fixed.MAX_NAME_LENGTH, "name too long"))


def allowed_extensions(include: str | None = None, override: str | None = None) -> list[str]:
    """The allow-list after the two comma-separated adjustments."""
    def parse(text):
        items = [p.strip() for p in (text or "").split(",")]
        return [p if p.startswith(".") else "." + p for p in items if p]

    base = parse(override) or list(fixed.ALLOWED_EXTENSIONS)
    return list(dict.fromkeys(base + parse(include)))


def has_allowed_extension(name, include: str | None = None, override: str | None = None) -> Column:
    return extension(name).isin(allowed_extensions(include, override))


def safe_filename(c) -> Column:
    return F.regexp_replace(col(c), fixed.UNSAFE_FILENAME_CHARS, "")


# ---------------------------------------------------------------- page ids and titles

def page_id_from_href(href) -> Column:
    """Trailing run of 8+ digits, with or without ``.html``."""
    return group(href, r"(\d{8,})(?:\.html)?$")


def page_id_from_name(name) -> Column:
    """First run of 8+ digits anywhere."""
    return group(name, r"(\d{8,})")


def page_id_from_filename(name) -> Column:
    """``Title_<id>.html`` or an all-digit stem; empty otherwise."""
    bare = F.replace(col(name), F.lit("clean_"), F.lit(""))
    return F.coalesce(group(bare, fixed.PAGE_ID_IN_FILENAME),
                      group(stem(bare), r"^(\d+)$"), F.lit(""))


def title_from_html(html, filename) -> Column:
    """``<title>``, else first ``<h1>``, else the file name in words."""
    def tag_text(tag):
        # a non-greedy body up to the first closing tag
        body = F.regexp_extract(col(html), rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)
        return squeeze(F.regexp_replace(strip(body), r"<[^>]+>", ""))

    words = F.regexp_replace(stem(filename), "[_-]", " ")
    fallback = F.initcap(squeeze(words))
    title, heading = tag_text("title"), tag_text("h1")
    return (F.when(F.length(title) > 3, title).when(F.length(heading) > 3, heading)
            .when(fallback != "", fallback).otherwise(F.lit(fixed.UNTITLED)))


def without_title_prefix(title) -> Column:
    return F.regexp_replace(col(title), "(?i)" + fixed.TITLE_PREFIX, "")


def detect_content_type(text) -> Column:
    return F.when(col(text).rlike(f"(?i){fixed.HTML_MARKERS}"), "html").otherwise("markdown")


# ---------------------------------------------------------------- items

def item_type(child_count, parent_label: str = "collection") -> Column:
    return F.when(col(child_count) > 0, parent_label).otherwise("page")


def space_key_or_default(space_key, folder) -> Column:
    return F.lower(F.coalesce(col(space_key), col(folder)))


def default_content(title, html_page, file_exists, converted) -> Column:
    """Markdown of an item: converted page, or the stub for a lost or absent page."""
    head = F.concat(F.lit("# "), col(title), F.lit("\n\n"))
    return (F.when(col(html_page).isNull(), F.concat(head, F.lit(fixed.COLLECTION_STUB)))
            .when(~col(file_exists), F.concat(head, F.lit(fixed.NOT_FOUND_STUB)))
            .otherwise(col(converted)))


def is_image(content_type, path) -> Column:
    suffix = "|".join(e.lstrip(".") for e in fixed.IMAGE_EXTENSIONS)
    return (F.coalesce(col(content_type), F.lit("")).startswith("image/")
            | F.lower(col(path)).rlike(rf"\.({suffix})\z"))


def mime_table(spark: SparkSession, extra: dict[str, str] | None = None) -> DataFrame:
    """(ext, mime_type) as a literal relation; ``extra`` adds or replaces rows."""
    rows = {**fixed.MIME_TYPES, **(extra or {})}
    values = ", ".join(f"('{e}', '{m}')" for e, m in rows.items())
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(ext, mime_type)")


def with_mime_type(df: DataFrame, name: str, out: str = "mime_type",
                   table: DataFrame | None = None) -> DataFrame:
    """Left join on the lower-cased extension, default type where unknown.

    The table is a literal relation of known size, so Catalyst may broadcast it.
    """
    table = (table if table is not None else mime_table(df.sparkSession)).select(
        F.col("ext").alias("_ext"), F.col("mime_type").alias("_mime"))
    packed = F.regexp_replace(F.lower(F.col(name)), r"\.(gz|bz2|xz|z|br)\z", "")
    return (df.withColumn("_ext", extension(packed)).join(table, "_ext", "left")
            .withColumn(out, F.coalesce("_mime", F.lit(fixed.DEFAULT_MIME)))
            .drop("_ext", "_mime"))


# ---------------------------------------------------------------- API responses

def response_class(status) -> Column:
    s = col(status)
    return (F.when(s == 200, "ok").when(s == 429, "limited")
            .when((s >= 400) & (s < 500), "client_error")
            .when((s >= 500) & (s < 600), "server_error").otherwise("other"))


def response_error(status, body, retry_after) -> Column:
    """Error text of a response; null on success."""
    s = col(status)
    wait = F.coalesce(col(retry_after).cast("int"), F.lit(fixed.DEFAULT_RETRY_AFTER))
    return (F.when(s == 200, F.lit(None).cast("string"))
            .when(s == 429, F.concat(F.lit("Rate limited - retry after "),
                                     wait.cast("string"), F.lit(" seconds")))
            .otherwise(F.coalesce(F.get_json_object(col(body), "$.message"),
                                  F.concat(F.lit("HTTP "), s.cast("string")))))


