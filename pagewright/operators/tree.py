"""Page trees in adjacency form: one row per node, the path is the key.

Ancestors are prefixes of the path, so nothing recurses. Lookups by prefix start from the
distinct parent paths, which are few and unique, not from the nodes: a parent with a third of
all pages below it appears once.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.text import item_type, page_id_from_name
from pagewright.operators.numbering import running_sum
from pagewright.session import stage

KEY = ["space_key", "path"]


def parent_of(path="path") -> Column:
    p = F.col(path)
    return F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))


def prefixes(path="path", include_self: bool = True) -> Column:
    """All leading parts of a path, shortest first."""
    p = F.col(path)
    upto = F.size(p) if include_self else F.size(p) - 1
    return F.when(upto > 0, F.transform(F.sequence(F.lit(1), upto), lambda i: F.slice(p, 1, i))) \
            .otherwise(F.array().cast("array<array<string>>"))


def dedupe_paths(links: DataFrame) -> DataFrame:
    """One record per path: the last one wins but keeps the first one's position."""
    values = [c for c in links.columns if c not in ("space_key", "path", "pos")]
    return (links.groupBy(*KEY)
            .agg(F.max_by(F.struct(*values), F.col("pos")).alias("_last"), F.min("pos").alias("pos"))
            .select(*KEY, "pos", "_last.*"))


def _parents(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.size("path") > 1).select("space_key", parent_of().alias("parent_path")).distinct()


def _complete_parents(nodes: DataFrame) -> DataFrame:
    """Parent paths all of whose prefixes, themselves included, are nodes."""
    asked = _parents(nodes).select("space_key", "parent_path", F.explode(prefixes("parent_path")).alias("path"))
    return (asked.join(nodes.select(*KEY), KEY)
            .groupBy("space_key", "parent_path").agg(F.count(F.lit(1)).alias("found"))
            .where(F.col("found") == F.size("parent_path")).drop("found"))


def build_tree(links: DataFrame, parent_label: str = "navigation", staged: bool = False) -> DataFrame:
    """Nodes reachable from depth-1 roots, with parent path, depth and type.

    The distinct nodes are read several times; ``staged`` writes them to the shared folder
    first, for links that are costly to compute.
    """
    nodes = (dedupe_paths(links).where(F.size("path") > 0)
             .withColumn("parent_path", parent_of()).withColumn("depth", F.size("path")))
    if staged:
        nodes = stage(nodes, "nodes")
    complete = _complete_parents(nodes)
    inner = nodes.where("depth > 1").join(complete, ["space_key", "parent_path"], "left_semi")
    kept = nodes.where("depth = 1").unionByName(inner)
    has_child = complete.select("space_key", F.col("parent_path").alias("path"), F.lit(1).alias("_kids"))
    return (kept.join(has_child, KEY, "left")
            .withColumn("type", item_type(F.coalesce("_kids", F.lit(0)), parent_label)).drop("_kids"))


def parent_join(nodes: DataFrame) -> DataFrame:
    """Each node with its parent's title and position, null for roots and orphans."""
    up = nodes.select("space_key", F.col("path").alias("parent_path"),
                      F.col("title").alias("parent_title"), F.col("pos").alias("parent_pos"))
    down = nodes.withColumn("parent_path", parent_of())
    return down.join(up, ["space_key", "parent_path"], "left")


def orphans(nodes: DataFrame) -> DataFrame:
    """Nodes below the first level whose parent path is missing."""
    known = nodes.select("space_key", F.col("path").alias("parent_path"))
    return (nodes.where(F.size("path") > 1).withColumn("parent_path", parent_of())
            .join(known, ["space_key", "parent_path"], "left_anti"))


def roots(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.size("path") == 1).orderBy("space_key", "pos")


def opening(path="path") -> Column:
    """The place in pre-order where a path opens; all places inside its subtree follow."""
    return F.transform(path, lambda name: F.struct(F.lit(0).alias("last"), name.alias("name")))


def closing(path="path") -> Column:
    """The place after all of a path's subtree, before its next sibling."""
    return F.concat(opening(path), F.array(F.struct(F.lit(1).alias("last"), F.lit(None).cast("string").alias("name"))))


def intervals(nodes: DataFrame, value: Column | None = None) -> DataFrame:
    """(space_key, path, first, last) per distinct path: the subtree of a node is the rows whose
    ``first`` lies in its own ``first`` to ``last``.

    Nodes open and close once each; one sort by ranges puts both in pre-order and running
    counts are the labels, so a tree of any depth costs two rows a node and a hot space is
    spread over ranges. With ``value`` (not negative) the labels count it in place of rows:
    ``last`` - ``first`` + 1 is then its sum over the subtree.
    """
    value = (F.lit(1) if value is None else value).cast("long")
    own = nodes.select(*KEY, opening().alias("_at"), value.alias("_v"), F.lit(True).alias("_opens"))
    ends = nodes.select(*KEY, closing().alias("_at"), F.lit(0).cast("long").alias("_v"), F.lit(False).alias("_opens"))
    walked = running_sum(own.unionByName(ends), ["space_key"], ["_at"], "_v", "_upto")
    return walked.groupBy(*KEY).agg(F.min(F.when(F.col("_opens"), F.col("_upto") - F.col("_v") + 1)).alias("first"),
                                    F.max("_upto").alias("last"))


def subtree_sizes(nodes: DataFrame) -> DataFrame:
    """Number of items in the subtree of each node, itself included."""
    return intervals(nodes).select(*KEY, (F.col("last") - F.col("first") + 1).alias("items"))


def structure_stats(links: DataFrame, tree: DataFrame) -> DataFrame:
    """Per space: links, leaf pages, navigation nodes, depth over all links, distinct paths."""
    by_link = links.groupBy("space_key").agg(
        F.count(F.lit(1)).alias("total_links_found"),
        F.max(F.size("path")).alias("max_depth"),
        F.count_distinct("path").alias("unique_paths"))
    by_node = tree.groupBy("space_key").agg(
        F.count_if(F.col("type") == "page").alias("total_pages"),
        F.count_if(F.col("type") == "navigation").alias("total_navigation_nodes"))
    return by_link.join(by_node, "space_key", "left").na.fill(0, ["total_pages", "total_navigation_nodes"])


def first_k_links(links: DataFrame, k: int = 10) -> DataFrame:
    """First links of each space in document order; Spark limits groups before the shuffle."""
    w = Window.partitionBy("space_key").orderBy("pos")
    return (links.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumn("href", F.substring("href", 1, 30)))


def convert_items(tree: DataFrame, files: DataFrame) -> DataFrame:
    """Content items with their default fields; ``html_page`` only where the file exists."""
    present = files.select("space_key", "href").distinct().withColumn("html_page", F.col("href"))
    return (tree.join(present, ["space_key", "href"], "left")
            .withColumn("type", F.when(F.col("type") == "page", "page").otherwise("collection"))
            .withColumns({"md_content": F.lit(""), "parent_uuid": F.lit(None).cast("string"),
                          "page_uuid": F.lit(None).cast("string"), "created": F.lit(False)})
            .withColumn("attachment_page_id", page_id_from_name("href")))


def space_documents(metadata: DataFrame, stats: DataFrame, tree: DataFrame) -> DataFrame:
    """Header row per space; its content stays in the item rows."""
    counts = tree.groupBy("space_key").agg(F.count_if(F.col("depth") == 1).alias("root_items"),
                                           F.count(F.lit(1)).alias("total_items"))
    return (metadata.join(stats, "space_key", "left").join(counts, "space_key", "left")
            .withColumn("description", F.coalesce("description", F.lit("")))
            .withColumn("local_folder", F.concat_ws("/", F.lit("input"), "export", "folder")))


def latest_export(spaces: DataFrame) -> DataFrame:
    """One row per space key when several exports hold it: the latest export name wins."""
    values = [c for c in spaces.columns if c != "space_key"]
    return (spaces.groupBy("space_key")
            .agg(F.max_by(F.struct(*values), F.col("export")).alias("_s")).select("space_key", "_s.*"))


# ---------------------------------------------------------------- folders of legacy pages

def folder_tree(pages: DataFrame) -> DataFrame:
    """Every prefix of every page path is a folder; ordering by path walks the tree with
    children sorted by name."""
    return (pages.select(F.explode(prefixes()).alias("path")).distinct()
            .withColumns({"title": F.element_at("path", -1), "depth": F.size("path")})
            .orderBy("path"))


def folder_pages(pages: DataFrame) -> DataFrame:
    """Pages placed under the folder with their path; root pages have the empty path."""
    return pages.withColumn("folder", F.col("path")).withColumn(
        "path", F.concat("folder", F.array("title")))


def integrated_navigation(pages: DataFrame) -> DataFrame:
    """Folders, embedded pages and root pages as one adjacency table."""
    folders = folder_tree(pages).select(
        F.lit("navigation").alias("type"), "path", "title", F.lit(None).cast("string").alias("page_id"),
        F.lit(None).cast("long").alias("attachment_count"))
    placed = folder_pages(pages).select(
        F.when(F.size("folder") > 0, "page").otherwise("root_page").alias("type"),
        "path", "title", "page_id", F.col("attachment_count").cast("long").alias("attachment_count"))
    return folders.unionByName(placed)


def navigation_totals(nav: DataFrame) -> DataFrame:
    return nav.agg(F.count_if(F.col("type") == "navigation").alias("total_navigation_nodes"),
                   F.count_if(F.col("type") != "navigation").alias("total_pages"),
                   F.coalesce(F.sum("attachment_count"), F.lit(0)).alias("total_attachments"))
