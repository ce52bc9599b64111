"""Space documents: nested JSON at the border, adjacency rows inside.

A space of any size is stored as many rows below ``space_key=<key>/``, never as one value.
Nested documents of other tools are read level by level and flattened, whatever their depth.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.functions.markdown import clean_page_text
from pagewright.functions.text import basename
from pagewright.operators.numbering import number_rows
from pagewright.session import stage

CHILDREN_PER_ROW = 1000

_ITEM_FIELDS = ("title string, html_page string, md_content string, parent_uuid string, "
                "page_uuid string, created boolean, type string, attachments array<string>")


# Children stay JSON text until their level is read, so documents may be of any depth.
_ITEMS = "array<struct<" + ", ".join(
    f"{name}: {kind}" for name, kind in (f.split(" ", 1) for f in _ITEM_FIELDS.split(", "))) + ", children: string>>"


def space_schema() -> T.StructType:
    stats = ("struct<total_pages: int, total_navigation_nodes: int, max_depth: int, "
             "processed_at: timestamp, content_extracted_at: timestamp, uploaded_at: timestamp, "
             "collection_id: string, upload_successful: boolean>")
    return T._parse_datatype_string(
        f"space_name string, space_key string, description string, local_folder string, "
        f"processing_stats {stats}, space_content {_ITEMS}")


def scan_space_json(spark: SparkSession, folder: str, multiline: bool = True) -> DataFrame:
    """Stored space documents, one row each, under an explicit schema."""
    return (spark.read.schema(space_schema()).json(folder, multiLine=multiline)
            .withColumn("file_key", F.regexp_replace(basename(F.col("_metadata.file_path")), r"\.json$", "")))


def missing_keys(requested: DataFrame, spaces: DataFrame) -> DataFrame:
    """Requested keys without a document: reported and skipped."""
    return requested.join(spaces.select("space_key"), "space_key", "left_anti")


def parse_space_json(texts: DataFrame) -> DataFrame:
    """Space documents from a JSON text column ``json``."""
    return texts.withColumn("doc", F.from_json("json", space_schema())).select(
        *[c for c in texts.columns if c != "json"], "doc.*")


def flatten_space_json(spaces: DataFrame) -> DataFrame:
    """Items of nested documents as rows with their path and depth.

    Goes down level by level until one is empty, so a document of any depth is whole; each
    level is a staged table that holds the text of the levels below it.
    """
    names = [f.split(" ")[0] for f in _ITEM_FIELDS.split(", ")]
    keep = [c for c in spaces.columns if c != "space_content"]
    level = spaces.select(*keep, F.explode("space_content").alias("i"), F.array().cast("array<string>").alias("_up"))
    levels = []
    while True:
        here = stage(level.select(
            *keep, F.concat("_up", F.array("i.title")).alias("path"), F.lit(len(levels) + 1).alias("depth"),
            *[f"i.{n}" for n in names], F.col("i.children").alias("_children")), "items-of-level")
        if levels and here.isEmpty():
            break
        levels.append(here.drop("_children"))
        level = here.select(*keep, F.explode(F.from_json("_children", _ITEMS)).alias("i"), F.col("path").alias("_up"))
    return reduce(DataFrame.unionByName, levels)


def nest_space_json(items: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Children of each parent as JSON arrays, in order: (space_key, parent_path, chunk, children).

    A parent with more than ``CHILDREN_PER_ROW`` children takes several chunks, to be read in
    order, so no parent is gathered whole. Roots have the empty parent path.
    """
    fields = fields or ["title", "type", "html_page", "page_uuid", "created"]
    up = F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0)))
    placed = items.select("space_key", up.alias("parent_path"), "pos", *fields)
    numbered = number_rows(placed, ["space_key", "parent_path"], ["pos"])
    return (numbered.withColumn("chunk", F.floor((F.col("rn") - 1) / CHILDREN_PER_ROW).cast("long"))
            .groupBy("space_key", "parent_path", "chunk")
            .agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("rn", *fields))),
                                       lambda x: x.dropFields("rn"))).alias("children")))


def write_spaces(items: DataFrame, folder: str) -> None:
    """Items as JSON rows below one folder per space, replacing only the spaces written.

    The rebalance hint splits a space with many items over several files.
    """
    (items.hint("rebalance", "space_key").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("space_key").json(folder))


def read_spaces(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(folder)


def clean_pages_output(cleaned: DataFrame) -> DataFrame:
    """(output, body): target name and text of every cleaned page."""
    return cleaned.where("error is null").select(
        F.concat(F.lit("clean_"), F.col("filename")).alias("output"),
        clean_page_text("breadcrumb", "title", "clean_content").alias("body"))


def write_clean(cleaned: DataFrame, folder: str) -> None:
    """Cleaned pages as a parquet table of (output, body)."""
    clean_pages_output(cleaned).write.mode("overwrite").parquet(folder)
