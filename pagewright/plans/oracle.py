"""SQL twins of the fixtures, and the composition of oracle queries from them."""
from __future__ import annotations

import re

_PLACES = "nation JOIN region ON n_regionkey = r_regionkey"
_CUST = f"customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_SUPP = f"supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def _link(source: str, base: int, key: str, path: str, title: str, level: int, where: str = "true") -> str:
    return (f"SELECT lower(r_name) AS space_key, CAST({base} + {key} AS BIGINT) AS pos, {title} AS title, "
            f"{path} AS path, regexp_replace({title}, '[^A-Za-z]', '', 'g') || '_' || ({base} + {key}) || '.html' AS href, "
            f"CAST({base} + {key} AS VARCHAR) AS page_id, {level} AS hierarchy_level FROM {source} WHERE {where}")


CTES = {
    "fx_links": " UNION ALL ".join([
        _link("region", 10000000, "r_regionkey", "[r_name]", "r_name", 1),
        _link(_PLACES, 20000000, "n_nationkey", "[r_name, n_name]", "n_name", 2),
        _link(_CUST, 300000000, "c_custkey", "[r_name, n_name, c_name]", "c_name", 3),
        _link(_SUPP, 900000000, "s_suppkey", "[r_name, n_name, 'Vendor ' || (s_suppkey % 3)]",
              "('Vendor ' || (s_suppkey % 3))", 3),
        _link(_SUPP, 950000000, "s_suppkey", "[r_name, 'Missing', s_name]", "s_name", 3, "s_suppkey % 10 = 0"),
        _link(_SUPP, 970000000, "s_suppkey", "CAST([] AS VARCHAR[])", "s_name", 0, "s_suppkey % 25 = 0"),
    ]),
    "fx_dedup": """
        SELECT space_key, path, min(pos) AS pos, arg_max(title, pos) AS title, arg_max(href, pos) AS href,
               arg_max(page_id, pos) AS page_id, arg_max(hierarchy_level, pos) AS hierarchy_level
        FROM fx_links GROUP BY space_key, path""",
    "fx_reach": """
        SELECT * FROM fx_dedup d WHERE len(path) = 1
        UNION ALL SELECT * FROM fx_dedup d WHERE len(path) = 2
            AND EXISTS (SELECT 1 FROM fx_dedup p WHERE p.space_key = d.space_key AND p.path = d.path[1:1])
        UNION ALL SELECT * FROM fx_dedup d WHERE len(path) = 3
            AND EXISTS (SELECT 1 FROM fx_dedup p WHERE p.space_key = d.space_key AND p.path = d.path[1:1])
            AND EXISTS (SELECT 1 FROM fx_dedup p WHERE p.space_key = d.space_key AND p.path = d.path[1:2])""",
    "fx_nodes": """
        SELECT n.*, n.path[1:len(n.path) - 1] AS parent_path, CAST(len(n.path) AS INTEGER) AS depth,
               CASE WHEN k.path IS NULL THEN 'page' ELSE 'navigation' END AS type
        FROM fx_reach n LEFT JOIN (SELECT DISTINCT space_key, path[1:len(path) - 1] AS path FROM fx_reach) k
          ON k.space_key = n.space_key AND k.path = n.path""",
    "fx_files": "SELECT space_key, href FROM fx_links WHERE pos % 7 <> 0",
    "fx_items": """
        SELECT * EXCLUDE (type), CASE WHEN type = 'page' THEN 'page' ELSE 'collection' END AS type,
          CASE WHEN p % 11 = 0 THEN '' ELSE '# ' || title || chr(10) || chr(10) || 'Body of ' || title END AS md_content,
          CASE WHEN p < 20000000 THEN 'col-' || (p - 10000000) WHEN p < 300000000 THEN 'nat-' || (p - 20000000)
               WHEN p < 900000000 AND (p - 300000000) % 3 <> 0 THEN 'doc-' || (p - 300000000) END AS page_uuid,
          (p < 300000000 OR (p < 900000000 AND (p - 300000000) % 4 <> 0)) AS created
        FROM (SELECT *, CAST(page_id AS BIGINT) AS p FROM fx_nodes)""",
    "fx_att": """
        SELECT lower(r_name) AS space_key, CAST(300000000 + o_custkey AS VARCHAR) AS page_id, l.name,
               'attachments/' || (300000000 + o_custkey) || '/' || l.name AS path,
               l_orderkey * 10 + l_linenumber AS ord, l_orderkey, l_linenumber,
               CAST(trunc(price) AS BIGINT) AS size, line_status, return_flag, quantity, shipped
        FROM (SELECT l_orderkey, l_linenumber, min(l_linestatus) AS line_status, min(l_returnflag) AS return_flag,
                     max(l_quantity) AS quantity, max(l_extendedprice) AS price, max(l_shipdate) AS shipped,
                     l_orderkey || '_' || l_linenumber || CASE l_linenumber % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.pdf'
                        WHEN 2 THEN '.docx' ELSE '.bin' END AS name
              FROM lineitem GROUP BY l_orderkey, l_linenumber) l
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fx_det": """
        SELECT space_key, page_id, path, ord, 'att-' || l_orderkey || '-' || l_linenumber AS attachment_id,
          CASE WHEN line_status = 'F' THEN 'https://kb/api/attachments.redirect?id=att-' || l_orderkey || '-' || l_linenumber END AS api_url,
          name, CASE l_linenumber % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'text/plain' ELSE '' END AS content_type,
          size, line_status = 'F' AS uploaded,
          CASE WHEN line_status <> 'F' AND return_flag <> 'N' THEN shipped END AS upload_failed_at
        FROM fx_att WHERE quantity > 5""",
    "fx_spaces": """SELECT lower(r_name) AS space_key, r_name AS space_name, 'col-' || r_regionkey AS collection_id FROM region""",
    "fx_docs": """
        SELECT 'doc-' || c_custkey AS id, 'col-' || n_regionkey AS collection_id, c_name AS title,
          '# ' || c_name || chr(10) || chr(10) || 'Body of ' || c_name || CASE WHEN c_custkey % 6 = 0 THEN ' changed' ELSE '' END AS text,
          TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey % 1000) AS updated_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 5 <> 0
        UNION ALL SELECT 'nat-' || n_nationkey, 'col-' || n_regionkey, n_name,
          '# ' || n_name || chr(10) || chr(10) || 'Body of ' || n_name,
          TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n_nationkey) FROM nation""",
    "fx_sspaces": """
        SELECT 's' || s_suppkey AS space_key, s_name AS space_name,
          CASE WHEN s_suppkey % 11 = 3 THEN 'col-gone' WHEN s_suppkey % 4 = 0 THEN 'col-' || s_suppkey END AS stored_id,
          CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey % 3 + 1 END AS choice FROM supplier""",
    "fx_cols": """
        SELECT 'col-' || s_suppkey || suffix AS id, s_name AS name,
          CASE WHEN s_suppkey % 13 <> 0 THEN document_count END AS document_count,
          coalesce(updated_at, TIMESTAMP '2000-01-01 00:00:00') AS updated_at
        FROM (SELECT *, unnest(CASE WHEN s_suppkey % 7 = 2 THEN ['-a', '-b'] ELSE [''] END) AS suffix FROM supplier WHERE s_suppkey % 5 <> 4) s
        LEFT JOIN (SELECT l_suppkey, count(*) AS document_count, max(l_shipdate) AS updated_at FROM lineitem GROUP BY 1) c
          ON s_suppkey = l_suppkey""",
    "fx_try": """
        SELECT 'r' || user_id || '-' || (n // 6) AS request_id, 'u' || user_id AS item, CAST(n % 6 AS INTEGER) AS attempt, event_id,
          event_id % 10 = 0 AS network_error, st AS status_code,
          CASE WHEN st = 429 AND event_id % 2 = 0 THEN value END AS retry_after
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n,
                CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_type = 'purchase' THEN 500
                     WHEN event_type = 'signup' THEN 200 ELSE 429 END AS st FROM events)""",
    "fx_outcome": """
        SELECT request_id, any_value(item) AS item, min(event_id) AS seq,
          CASE WHEN fa IS NULL THEN (CASE WHEN max(attempt) < 5 THEN 'open'
                 WHEN bool_or(attempt = 5 AND network_error) THEN 'network_error' ELSE 'rate_limited' END)
               WHEN bool_or(attempt = fa AND status_code = 200) THEN 'succeeded' ELSE 'error' END AS outcome,
          CAST(coalesce(fa, max(attempt)) + 1 AS INTEGER) AS attempts,
          max(CASE WHEN attempt = fa THEN status_code END) AS status_code
        FROM (SELECT *, min(CASE WHEN NOT network_error AND status_code <> 429 THEN attempt END)
                OVER (PARTITION BY request_id) AS fa FROM fx_try)
        GROUP BY request_id, fa""",
    "fx_results": """
        SELECT request_id AS file_path, item, seq, outcome = 'succeeded' AS success,
          CASE WHEN outcome <> 'succeeded' THEN outcome END AS error, CAST(attempts AS DOUBLE) AS duration FROM fx_outcome""",
    "fx_zip": """
        SELECT 'Confluence-space-export-' || l_suppkey || '-' || (l_partkey % 40) || '.html.zip' AS zip_file,
          CASE WHEN l_orderkey % 97 = 0 THEN '../' WHEN l_orderkey % 89 = 0 THEN '/' ELSE '' END
          || 'IS/attachments/' || l_partkey || '/' || l_orderkey || '_' || l_linenumber
          || CASE WHEN l_orderkey % 83 = 0 THEN repeat('x', 260) ELSE '' END
          || CASE l_linenumber % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.PDF' WHEN 2 THEN '.docx' ELSE '.bin' END AS member,
          CAST(trunc(l_extendedprice * 1020) AS BIGINT) AS file_size FROM lineitem""",
    "fx_guard": """
        SELECT *, CASE WHEN starts_with(member, '/') OR contains(member, '..') THEN 'suspicious path'
             WHEN file_size > 104857600 THEN 'file too large' WHEN length(member) > 255 THEN 'name too long' END AS reason FROM fx_zip""",
    "fx_zips": """
        SELECT zip_file, count(*) AS files, CAST(sum(file_size) AS BIGINT) AS total_size, count(reason) AS blocked,
          CASE WHEN count(*) > 20 THEN 'Archive contains too many files (' || count(*) || ' > 20)'
               WHEN sum(file_size) > 1073741824 THEN 'Archive too large when uncompressed (' || CAST(sum(file_size) AS BIGINT) || ' bytes)' END AS error
        FROM fx_guard GROUP BY zip_file""",
    "fx_paths": """
        SELECT 'input/' || CASE WHEN page_id % 3 = 0 THEN 'Old-' ELSE 'Export-' END || (page_id % 5) || '/S' || (page_id % 11)
          || CASE WHEN page_id % 2 = 0 THEN '/index.html' ELSE '/Page_' || page_id || '.html' END AS path FROM pages""",
    "fx_first": """
        SELECT page_id, max(CASE WHEN rn = 1 THEN path END) AS p1, max(CASE WHEN rn = 2 THEN path END) AS p2
        FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ord) AS rn FROM fx_att) WHERE rn <= 2 GROUP BY page_id""",
    "fx_parts": f"""
        SELECT c.page_id, c_custkey, c_name, n_name, r_name, text, coalesce(p1, '') AS p1, coalesce(p2, '') AS p2
        FROM (SELECT *, CAST(300000000 + c_custkey AS VARCHAR) AS page_id FROM {_CUST}) c
        JOIN documents ON doc_id = c_custkey % (SELECT count(*) FROM documents)
        LEFT JOIN fx_first f ON f.page_id = c.page_id""",
    "fx_md": """
        SELECT *, '1. [Home](index.html)' || chr(10) || '2. [' || r_name || '](space.html)' || chr(10) || '3. ['
          || CASE WHEN c_custkey % 5 = 0 THEN 'Land' || chr(10) || 'of ' ELSE '' END || n_name || '](land.html)' || chr(10) || chr(10)
          || '# ' || r_name || ' : ' || c_name || chr(10) || chr(10) || text || repeat(chr(10), 4) || '*' || chr(10) || chr(10)
          || 'Created by Ann, last modified by Bob on Jan 01, 2024' || chr(10) || chr(10)
          || 'Document generated by Confluence on Jan 01, 2024 10:00' || chr(10) || chr(10)
          || '![](' || p1 || ') and [file](' || p2 || ') and {' || p1 || '}' || chr(10) AS content FROM fx_parts""",
    "fx_visible": r"""
        SELECT page_id, url, html, regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)', '', 'g') AS src FROM pages""",
    "fx_tokens": r"""
        SELECT page_id, pos, token,
          CASE WHEN starts_with(token, '</') THEN 'close' WHEN regexp_matches(token, '^<[!?]') THEN 'decl'
               WHEN regexp_matches(token, '(?i)^<(area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr)[\s/>]')
                 OR regexp_matches(token, '(?s)^<[a-zA-Z].*/>\z') THEN 'void'
               WHEN regexp_matches(token, '(?s)^<[a-zA-Z].*>\z') THEN 'open' ELSE 'text' END AS kind,
          nullif(lower(regexp_extract(token, '^</?([a-zA-Z][^\s/>]*)', 1)), '') AS name
        FROM (SELECT page_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS token FROM (
          SELECT page_id, regexp_extract_all(src, '<[a-zA-Z/!?][^>=]*(?:=\s*(?:"[^"]*"|''[^'']*''|[^\s>]*)[^>=]*)*>|[^<]+|<') AS t FROM fx_visible))""",
    "fx_nested": """
        SELECT *, CASE kind WHEN 'open' THEN lvl WHEN 'close' THEN lvl + 1 END AS depth FROM (
          SELECT *, sum(CASE kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END)
            OVER (PARTITION BY page_id, name ORDER BY pos) AS lvl FROM fx_tokens)""",
    "fx_elements": """
        SELECT page_id, name, pos AS "start", CASE WHEN nk = 'close' THEN np END AS "end", token FROM (
          SELECT *, lead(kind) OVER w AS nk, lead(pos) OVER w AS np FROM fx_nested
          WINDOW w AS (PARTITION BY page_id, name, depth ORDER BY pos)) WHERE kind = 'open'""",
}


def compose(sql: str) -> str:
    """Prepend the fixtures a query names, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_\w+", text):
            if name not in order:
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in order) + " " + sql
