"""Page trees over the derived links."""
from pyspark.sql import functions as F

from pagewright.functions import text
from pagewright.operators import legacy, sync, tree
from pagewright.plans.registry import label, query

PATH = "array_to_string(path, '/') AS path"


@query("dedupe_paths", f"SELECT space_key, {PATH}, pos, title, href, page_id FROM fx_dedup")
def _(fx):
    return tree.dedupe_paths(fx.links).select("space_key", label().alias("path"), "pos", "title", "href", "page_id")


@query("build_tree", f"SELECT space_key, {PATH}, depth, pos, type, page_id FROM fx_nodes")
def _(fx):
    return tree.build_tree(fx.links).select("space_key", label().alias("path"), "depth", "pos", "type", "page_id")


@query("tree_parent_join", """
    SELECT d.space_key, array_to_string(d.path, '/') AS path, p.title AS parent_title, p.pos AS parent_pos
    FROM fx_dedup d LEFT JOIN fx_dedup p ON p.space_key = d.space_key AND p.path = d.path[1:len(d.path) - 1] AND len(d.path) > 1
    WHERE len(d.path) > 0""")
def _(fx):
    nodes = tree.dedupe_paths(fx.links).where(F.size("path") > 0)
    return tree.parent_join(nodes).select("space_key", label().alias("path"), "parent_title", "parent_pos")


@query("tree_orphans", """
    SELECT d.space_key, array_to_string(d.path, '/') AS path, d.pos FROM fx_dedup d WHERE len(d.path) > 1 AND NOT EXISTS (
      SELECT 1 FROM fx_dedup p WHERE p.space_key = d.space_key AND p.path = d.path[1:len(d.path) - 1])""")
def _(fx):
    return tree.orphans(tree.dedupe_paths(fx.links)).select("space_key", label().alias("path"), "pos")


@query("tree_roots", "SELECT space_key, title, pos FROM fx_nodes WHERE depth = 1")
def _(fx):
    return tree.roots(fx.nodes).select("space_key", "title", "pos")


@query("structure_stats", """
    SELECT l.space_key, total_links_found, max_depth, unique_paths, total_pages, total_navigation_nodes FROM (
      SELECT space_key, count(*) AS total_links_found, CAST(max(len(path)) AS INTEGER) AS max_depth, count(DISTINCT path) AS unique_paths
      FROM fx_links GROUP BY 1) l
    JOIN (SELECT space_key, count(*) FILTER (type = 'page') AS total_pages, count(*) FILTER (type <> 'page') AS total_navigation_nodes
      FROM fx_nodes GROUP BY 1) n ON n.space_key = l.space_key""")
def _(fx):
    return tree.structure_stats(fx.links, fx.nodes)


@query("subtree_sizes", """
    SELECT n.space_key, array_to_string(n.path, '/') AS path, count(*) AS items
    FROM fx_nodes n JOIN fx_nodes d ON d.space_key = n.space_key AND d.path[1:len(n.path)] = n.path GROUP BY ALL""")
def _(fx):
    return tree.subtree_sizes(fx.nodes).select("space_key", label().alias("path"), "items")


@query("path_label", "SELECT pos, array_to_string(path, ' → ') AS label FROM fx_links")
def _(fx):
    return fx.links.select("pos", text.path_join("path").alias("label"))


@query("html_page_or_null", """
    SELECT n.space_key, array_to_string(n.path, '/') AS path, CASE WHEN n.href IN (SELECT href FROM fx_files) THEN n.href END AS html_page
    FROM fx_nodes n""")
def _(fx):
    return tree.convert_items(fx.nodes, fx.files).select("space_key", label().alias("path"), "html_page")


@query("convert_items", """
    SELECT n.space_key, array_to_string(n.path, '/') AS path, n.title, CASE WHEN n.type = 'page' THEN 'page' ELSE 'collection' END AS type,
      CASE WHEN n.href IN (SELECT href FROM fx_files) THEN n.href END AS html_page, '' AS md_content,
      CAST(NULL AS VARCHAR) AS page_uuid, CAST(NULL AS VARCHAR) AS parent_uuid, false AS created, coalesce(a.attachments, 0) AS attachments
    FROM fx_nodes n LEFT JOIN (SELECT page_id, count(*) AS attachments FROM fx_att GROUP BY 1) a ON a.page_id = n.page_id""")
def _(fx):
    counts = fx.listed.groupBy(F.col("page_id").alias("attachment_page_id")).agg(F.count(F.lit(1)).alias("attachments"))
    return (tree.convert_items(fx.nodes, fx.files).join(counts, "attachment_page_id", "left")
            .select("space_key", label().alias("path"), "title", "type", "html_page", "md_content", "page_uuid",
                    "parent_uuid", "created", F.coalesce("attachments", F.lit(0).cast("long")).alias("attachments")))


@query("space_documents", """
    SELECT s.space_key, s.space_name, 'Suppliers of ' || s.space_name AS description, 'input/Export-9/' || s.space_name AS local_folder,
      st.total_pages, st.total_navigation_nodes, st.max_depth, c.root_items, c.total_items
    FROM fx_spaces s JOIN (
      SELECT n.space_key, count(*) FILTER (type = 'page') AS total_pages, count(*) FILTER (type <> 'page') AS total_navigation_nodes,
        (SELECT CAST(max(len(path)) AS INTEGER) FROM fx_links l WHERE l.space_key = n.space_key) AS max_depth
      FROM fx_nodes n GROUP BY n.space_key) st ON st.space_key = s.space_key
    JOIN (SELECT space_key, count(*) FILTER (depth = 1) AS root_items, count(*) AS total_items FROM fx_nodes GROUP BY 1) c
      ON c.space_key = s.space_key""")
def _(fx):
    exports = fx.spaces.withColumn("export", F.explode(F.array(F.lit("Export-1"), F.lit("Export-9")))) \
        .withColumn("folder", F.col("space_name")) \
        .withColumn("description", F.concat(F.when(F.col("export") == "Export-9", "Suppliers of ").otherwise("Old "), "space_name"))
    stats = tree.structure_stats(fx.links, fx.nodes)
    return tree.space_documents(tree.latest_export(exports), stats, fx.nodes).select(
        "space_key", "space_name", "description", "local_folder", "total_pages", "total_navigation_nodes",
        "max_depth", "root_items", "total_items")


@query("first_k_links", """
    SELECT space_key, title, array_to_string(path, '/') AS path, hierarchy_level, href, rank FROM (
      SELECT *  EXCLUDE (href), left(href, 30) AS href, CAST(row_number() OVER (PARTITION BY space_key ORDER BY pos) AS INTEGER) AS rank FROM fx_links)
    WHERE rank <= 10""")
def _(fx):
    return tree.first_k_links(fx.links).select("space_key", "title", label().alias("path"), "hierarchy_level", "href", "rank")


@query("link_validation", """
    SELECT space_key, href, pos FROM fx_links WHERE href NOT IN (SELECT href FROM fx_files)""")
def _(fx):
    return sync.link_validation(fx.links, fx.files).select("space_key", "href", "pos")


@query("nav_mapping", """
    SELECT space_key, array_to_string(path, '/') AS path, title, page_id,
      CASE WHEN type = 'page' THEN 'document' ELSE 'collection' END AS target FROM fx_nodes""")
def _(fx):
    return sync.nav_mapping(fx.nodes).withColumn("path", label())


# ---------------------------------------------------------------- legacy folders

def legacy_pages(fx):
    """Markdown pages read back: path, title, id and attachment count."""
    pages = fx.markdown.select(
        F.concat(F.lit("clean_Page_"), "page_id", F.lit(".html")).alias("filename"), "content")
    return legacy.process_pages(pages, fx.attachments)


LEGACY = """(SELECT page_id, c_name AS title, [CASE WHEN c_custkey % 5 = 0 THEN 'Land of ' ELSE '' END || n_name] AS path,
    coalesce(n, 0) AS attachment_count
  FROM fx_parts LEFT JOIN (SELECT page_id AS pid, count(*) AS n FROM fx_att GROUP BY 1) ON pid = page_id)"""


@query("folder_tree", f"""
    SELECT DISTINCT array_to_string(path[1:i], '/') AS path, path[i] AS title, CAST(i AS INTEGER) AS depth
    FROM (SELECT path, unnest(range(1, len(path) + 1)) AS i FROM fx_links)""")
def _(fx):
    return tree.folder_tree(fx.links).withColumn("path", label())


@query("sorted_children", """
    SELECT DISTINCT array_to_string(path[1:i - 1], '/') AS parent, path[i] AS child FROM (SELECT path, unnest(range(1, len(path) + 1)) AS i FROM fx_links)""")
def _(fx):
    return tree.folder_tree(fx.links).select(F.array_join(tree.parent_of(), "/").alias("parent"), F.col("title").alias("child"))


@query("folder_pages", f"""
    SELECT page_id, array_to_string(path, '/') AS folder, array_to_string(path, '/') || '/' || title AS path FROM {LEGACY}""")
def _(fx):
    return tree.folder_pages(legacy_pages(fx)).select("page_id", label("folder").alias("folder"), label().alias("path"))


@query("integrated_navigation", f"""
    SELECT 'navigation' AS type, array_to_string(path, '/') AS path, path[1] AS title, CAST(NULL AS VARCHAR) AS page_id,
      CAST(NULL AS BIGINT) AS attachment_count FROM (SELECT DISTINCT path FROM {LEGACY})
    UNION ALL SELECT 'page', array_to_string(path, '/') || '/' || title, title, page_id, attachment_count FROM {LEGACY}""")
def _(fx):
    return tree.integrated_navigation(legacy_pages(fx)).withColumn("path", label())


@query("process_pages", f"""
    SELECT count(DISTINCT path) AS total_navigation_nodes, count(*) AS total_pages, CAST(sum(attachment_count) AS BIGINT) AS total_attachments
    FROM {LEGACY}""")
def _(fx):
    return tree.navigation_totals(tree.integrated_navigation(legacy_pages(fx)))
