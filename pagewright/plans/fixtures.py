"""Wiki shapes derived from the given tables, as DataFrames. ``oracle.py`` holds the SQL twins."""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators.numbering import number_rows
from pagewright.operators.tree import build_tree
from pagewright.session import configure

REGION, NATION, CUSTOMER = 10_000_000, 20_000_000, 300_000_000
VENDOR, ORPHAN, LOOSE = 900_000_000, 950_000_000, 970_000_000


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = configure(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # ------------------------------------------------------------ trees

    @cached_property
    def links(self) -> DataFrame:
        """Three-level tree per region, with repeated paths, orphans and unlisted links."""
        region, nation = self.table("region"), self.table("nation")
        places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        customers = self.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        suppliers = self.table("supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        vendor = F.concat(F.lit("Vendor "), (F.col("s_suppkey") % 3).cast("string"))

        def links(df, base, key, path, title, level):
            pos = F.lit(base).cast("long") + F.col(key)
            page_id = pos.cast("string")
            return df.select(
                F.lower("r_name").alias("space_key"), pos.alias("pos"), title.alias("title"),
                F.array(*path).cast("array<string>").alias("path"),
                F.concat(F.regexp_replace(title, "[^A-Za-z]", ""), F.lit("_"), page_id,
                         F.lit(".html")).alias("href"),
                page_id.alias("page_id"), F.lit(level).alias("hierarchy_level"))

        r, n, c, s = (F.col(x) for x in ("r_name", "n_name", "c_name", "s_name"))
        return (links(region, REGION, "r_regionkey", [r], r, 1)
                .unionByName(links(places, NATION, "n_nationkey", [r, n], n, 2))
                .unionByName(links(customers, CUSTOMER, "c_custkey", [r, n, c], c, 3))
                .unionByName(links(suppliers, VENDOR, "s_suppkey", [r, n, vendor], vendor, 3))
                .unionByName(links(suppliers.where("s_suppkey % 10 = 0"), ORPHAN, "s_suppkey",
                                   [r, F.lit("Missing"), s], s, 3))
                .unionByName(links(suppliers.where("s_suppkey % 25 = 0"), LOOSE, "s_suppkey", [], s, 0)))

    @cached_property
    def nodes(self) -> DataFrame:
        return build_tree(self.links)

    @cached_property
    def files(self) -> DataFrame:
        """Existing page files."""
        return self.links.where(F.col("pos") % 7 != 0).select("space_key", "href")

    @cached_property
    def items(self) -> DataFrame:
        """Tree items with the state a partly finished upload leaves behind."""
        p = F.col("page_id").cast("long")
        is_customer = p.between(CUSTOMER, VENDOR - 1)
        uuid = (F.when(p < NATION, F.concat(F.lit("col-"), (p - REGION).cast("string")))
                .when(p < CUSTOMER, F.concat(F.lit("nat-"), (p - NATION).cast("string")))
                .when(is_customer & ((p - CUSTOMER) % 3 != 0),
                      F.concat(F.lit("doc-"), (p - CUSTOMER).cast("string"))))
        text = F.when(p % 11 == 0, "").otherwise(
            F.concat(F.lit("# "), F.col("title"), F.lit("\n\nBody of "), F.col("title")))
        return (self.nodes
                .withColumn("type", F.when(F.col("type") == "page", "page").otherwise("collection"))
                .withColumns({
                    "md_content": text, "page_uuid": uuid, "parent_uuid": F.lit(None).cast("string"),
                    "created": (p < CUSTOMER) | (is_customer & ((p - CUSTOMER) % 4 != 0))}))

    # ------------------------------------------------------------ attachments

    @cached_property
    def attachments(self) -> DataFrame:
        """Files of customer pages, one per order line number, with the raw line state."""
        lines = self.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_linestatus").alias("line_status"), F.min("l_returnflag").alias("return_flag"),
            F.max("l_quantity").alias("quantity"), F.max("l_extendedprice").alias("price"),
            F.max("l_shipdate").alias("shipped"))
        owner = (self.table("customer")
                 .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                 .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                 .select(F.col("c_custkey").alias("o_custkey"), F.lower("r_name").alias("space_key")))
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        ext = F.element_at(F.array(*[F.lit(x) for x in (".png", ".pdf", ".docx", ".bin")]),
                           F.col("l_linenumber") % 4 + 1)
        name = F.concat(F.col("l_orderkey").cast("string"), F.lit("_"),
                        F.col("l_linenumber").cast("string"), ext)
        page_id = (F.lit(CUSTOMER).cast("long") + F.col("o_custkey")).cast("string")
        return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(owner, "o_custkey")
                .select("space_key", page_id.alias("page_id"), name.alias("name"),
                        F.concat(F.lit("attachments/"), page_id, F.lit("/"), name).alias("path"),
                        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
                        F.col("price").cast("long").alias("size"), "l_orderkey", "l_linenumber",
                        "line_status", "return_flag", "quantity", "shipped"))

    @cached_property
    def listed(self) -> DataFrame:
        return self.attachments.select("space_key", "page_id", "path", "ord")

    @cached_property
    def details(self) -> DataFrame:
        """Stored upload details of most attachments."""
        up = F.col("line_status") == "F"
        att = F.concat(F.lit("att-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                       F.col("l_linenumber").cast("string"))
        mime = F.element_at(F.array(*[F.lit(x) for x in ("image/png", "application/pdf", "text/plain", "")]),
                            F.col("l_linenumber") % 4 + 1)
        return (self.attachments.where("quantity > 5").select(
            "space_key", "page_id", "path", "ord", att.alias("attachment_id"),
            F.when(up, F.concat(F.lit("https://kb/api/attachments.redirect?id="), att)).alias("api_url"),
            "name", mime.alias("content_type"), "size", up.alias("uploaded"),
            F.when(~up & (F.col("return_flag") != "N"), F.col("shipped")).alias("upload_failed_at")))

    # ------------------------------------------------------------ remote state

    @cached_property
    def spaces(self) -> DataFrame:
        """One space per region, with its collection."""
        return self.table("region").select(
            F.lower("r_name").alias("space_key"), F.col("r_name").alias("space_name"),
            F.concat(F.lit("col-"), F.col("r_regionkey").cast("string")).alias("collection_id"))

    @cached_property
    def documents(self) -> DataFrame:
        """Snapshot of remote documents."""
        places = self.table("nation").withColumn(
            "collection_id", F.concat(F.lit("col-"), F.col("n_regionkey").cast("string")))
        c = self.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).where("c_custkey % 5 <> 0")
        tail = F.when(F.col("c_custkey") % 6 == 0, " changed").otherwise("")
        when = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_custkey % 1000)")
        when_n = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, n_nationkey)")

        def text(name, tail=F.lit("")):
            return F.concat(F.lit("# "), name, F.lit("\n\nBody of "), name, tail)

        docs = c.select(F.concat(F.lit("doc-"), F.col("c_custkey").cast("string")).alias("id"),
                        "collection_id", F.col("c_name").alias("title"),
                        text(F.col("c_name"), tail).alias("text"), when.alias("updated_at"))
        nats = places.select(F.concat(F.lit("nat-"), F.col("n_nationkey").cast("string")).alias("id"),
                             "collection_id", F.col("n_name").alias("title"),
                             text(F.col("n_name")).alias("text"), when_n.alias("updated_at"))
        return docs.unionByName(nats)

    @cached_property
    def supplier_spaces(self) -> DataFrame:
        """One space per supplier, with a stored collection id that is sometimes stale."""
        k = F.col("s_suppkey")
        stored = (F.when(k % 11 == 3, "col-gone").when(k % 4 == 0, F.concat(F.lit("col-"), k.cast("string"))))
        return self.table("supplier").select(
            F.concat(F.lit("s"), k.cast("string")).alias("space_key"), F.col("s_name").alias("space_name"),
            stored.alias("stored_id"), F.when(k % 2 == 0, (k % 3 + 1).cast("long")).alias("choice"))

    @cached_property
    def collections(self) -> DataFrame:
        """Remote collections: none, one or two per supplier."""
        k = F.col("s_suppkey")
        count = self.table("lineitem").groupBy("l_suppkey").agg(
            F.count(F.lit(1)).alias("document_count"), F.max("l_shipdate").alias("updated_at"))
        base = (self.table("supplier").where(k % 5 != 4).join(count, k == F.col("l_suppkey"), "left"))
        suffix = F.when(k % 7 == 2, F.array(F.lit("-a"), F.lit("-b"))).otherwise(F.array(F.lit("")))
        return (base.withColumn("suffix", F.explode(suffix))
                .select(F.concat(F.lit("col-"), k.cast("string"), F.col("suffix")).alias("id"),
                        F.col("s_name").alias("name"),
                        F.when(k % 13 != 0, F.col("document_count")).alias("document_count"),
                        F.coalesce("updated_at", F.expr("timestamp_ntz'2000-01-01 00:00:00'")).alias("updated_at")))

    # ------------------------------------------------------------ attempts

    @cached_property
    def attempts(self) -> DataFrame:
        """Request attempts from events: six in a row of one user form a request."""
        numbered = number_rows(self.table("events"), ["user_id"], ["ts", "event_id"])
        n = F.col("rn") - 1
        request = F.floor(n / 6).cast("long")
        kind, net = F.col("event_type"), F.col("event_id") % 10 == 0
        status = (F.when(net, F.lit(None).cast("int")).when(kind == "purchase", 500)
                  .when(kind == "signup", 200).otherwise(429))
        return numbered.select(
            F.concat(F.lit("r"), F.col("user_id").cast("string"), F.lit("-"), request.cast("string")).alias("request_id"),
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("item"),
            (n % 6).cast("int").alias("attempt"), "event_id",
            status.alias("status_code"), net.alias("network_error"),
            F.when(~net & (status == 429) & (F.col("event_id") % 2 == 0), F.col("value")).alias("retry_after"))

    @cached_property
    def results(self) -> DataFrame:
        """Outcome per request, in the order of the first event."""
        from pagewright.operators.sync import retry_outcome

        first = self.attempts.groupBy("request_id").agg(F.min("event_id").alias("seq"),
                                                        F.first("item").alias("item"))
        ok = F.col("outcome") == "succeeded"
        return (retry_outcome(self.attempts).join(first, "request_id").select(
            F.col("request_id").alias("file_path"), "item", "seq", ok.alias("success"),
            F.when(~ok, F.col("outcome")).alias("error"), F.col("attempts").cast("double").alias("duration")))

    # ------------------------------------------------------------ archives

    @cached_property
    def zip_members(self) -> DataFrame:
        """Archive listings with bad paths, large members and long names."""
        k, n = F.col("l_orderkey"), F.col("l_linenumber")
        ext = F.element_at(F.array(*[F.lit(x) for x in (".png", ".PDF", ".docx", ".bin")]), n % 4 + 1)
        member = F.concat(
            F.when(k % 97 == 0, "../").when(k % 89 == 0, "/").otherwise(""),
            F.lit("IS/attachments/"), F.col("l_partkey").cast("string"), F.lit("/"),
            k.cast("string"), F.lit("_"), n.cast("string"),
            F.when(k % 83 == 0, "x" * 260).otherwise(""), ext)
        archive = F.concat(F.lit("Confluence-space-export-"), F.col("l_suppkey").cast("string"), F.lit("-"),
                           (F.col("l_partkey") % 40).cast("string"), F.lit(".html.zip"))
        return self.table("lineitem").select(
            archive.alias("zip_file"), member.alias("member"),
            (F.col("l_extendedprice") * 1020).cast("long").alias("file_size"))

    @cached_property
    def page_archives(self) -> DataFrame:
        """One small archive per raw page, as (path, content); every tenth is damaged."""
        def build(batches):
            import io
            import zipfile

            for pdf in batches:
                def pack(row):
                    if row.page_id % 10 == 9:
                        return b"PK damaged"
                    buffer = io.BytesIO()
                    with zipfile.ZipFile(buffer, "w") as z:
                        z.writestr("IS/index.html", row.url)
                        z.writestr(f"IS/Page_{30_000_000 + row.page_id}.html", row.html)
                    return buffer.getvalue()

                yield pdf.assign(path="zips/page-" + pdf.page_id.astype(str) + ".html.zip",
                                 content=[pack(r) for r in pdf.itertuples()])[["path", "content"]]

        return self.table("pages").select("page_id", "url", "html").mapInPandas(
            build, "path string, content binary")

    @cached_property
    def file_paths(self) -> DataFrame:
        """Paths of an unpacked export, from the raw pages."""
        p = F.col("page_id")
        space = F.concat(F.lit("input/"), F.when(p % 3 == 0, "Old-").otherwise("Export-"),
                         (p % 5).cast("string"), F.lit("/S"), (p % 11).cast("string"))
        name = F.when(p % 2 == 0, "/index.html").otherwise(F.concat(F.lit("/Page_"), p.cast("string"), F.lit(".html")))
        return self.table("pages").select(F.concat(space, name).alias("path"))

    # ------------------------------------------------------------ markdown and wiki pages

    @cached_property
    def first_paths(self) -> DataFrame:
        """The first two attachment paths of each page."""
        from pyspark.sql import Window

        w = Window.partitionBy("page_id").orderBy("ord")
        top = self.listed.withColumn("rn", F.row_number().over(w)).where("rn <= 2")
        return top.groupBy("page_id").agg(F.max(F.when(F.col("rn") == 1, F.col("path"))).alias("p1"),
                                          F.max(F.when(F.col("rn") == 2, F.col("path"))).alias("p2"))

    @cached_property
    def page_parts(self) -> DataFrame:
        """Parts of one page per customer: place names, text and attachment paths."""
        n_docs = self.table("documents").select(F.count(F.lit(1))).scalar()
        customers = (self.table("customer")
                     .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                     .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                     .withColumn("doc_id", F.col("c_custkey") % n_docs))
        texts = self.table("documents").select("doc_id", "text")
        page_id = (F.lit(CUSTOMER).cast("long") + F.col("c_custkey")).cast("string")
        # texts last, so that they are not shuffled once more with the paths
        return (customers.withColumn("page_id", page_id).join(self.first_paths, "page_id", "left").join(texts, "doc_id")
                .select("page_id", "c_custkey", "c_name", "n_name", "r_name", "n_nationkey", "r_regionkey",
                        "text", F.coalesce("p1", F.lit("")).alias("p1"), F.coalesce("p2", F.lit("")).alias("p2")))

    @cached_property
    def markdown(self) -> DataFrame:
        """Legacy markdown pages: breadcrumbs, heading, text, furniture, references."""
        many = F.col("c_custkey") % 5 == 0
        content = F.concat(
            F.lit("1. [Home](index.html)\n2. ["), F.col("r_name"), F.lit("](space.html)\n3. ["),
            F.when(many, F.concat(F.lit("Land\nof "), F.col("n_name"))).otherwise(F.col("n_name")),
            F.lit("](land.html)\n\n# "), F.col("r_name"), F.lit(" : "), F.col("c_name"), F.lit("\n\n"),
            F.col("text"), F.lit("\n\n\n\n*\n\nCreated by Ann, last modified by Bob on Jan 01, 2024\n\n"
                                 "Document generated by Confluence on Jan 01, 2024 10:00\n\n"),
            F.lit("![]("), F.col("p1"), F.lit(") and [file]("), F.col("p2"), F.lit(") and {"), F.col("p1"),
            F.lit("}\n"))
        return self.page_parts.select("page_id", "c_custkey", "c_name", "n_name", "r_name", "text",
                                      "p1", "p2", content.alias("content"))

    @cached_property
    def wiki_pages(self) -> DataFrame:
        """The same pages as exported HTML."""
        html = F.concat(
            F.lit("<!DOCTYPE html><html><head><title>Information Systems : "), F.col("c_name"),
            F.lit("</title><style>p{}</style></head><body>"
                  '<div id="page"><div id="main-header"><div id="breadcrumb-section"><ol id="breadcrumbs">'
                  '<li><a href="index.html">Home</a></li><li>skipped</li><li><a href="land.html">'),
            F.col("n_name"), F.lit('</a></li></ol></div><h1 id="title-heading" class="pagetitle">'
                                   '<span id="title-text"> '), F.col("r_name"), F.lit(" : "), F.col("c_name"),
            F.lit(' </span></h1></div><div id="content"><div class="page-metadata">Created by Ann</div>'
                  '<div id="main-content" class="wiki-content group"><div class="side nav-box">Menu</div><h2>'),
            F.col("c_name"), F.lit("</h2><p>"),
            F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
            F.lit("</p><div> </div><ul><li>one</li><li>two <b>bold</b></li></ul>"
                  "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>"
                  '<p><img src="'), F.col("p1"), F.lit('?width=760" alt="pic"> <a class="x" href="'), F.col("p2"),
            F.lit('?v=1">file</a> <a href="../other/'), F.col("p1"), F.lit('">rel</a></p></div></div>'
                  '<div id="footer"><p>Document generated by Confluence on Jan 01, 2024</p>'
                  '<a href="http://www.atlassian.com">Atlassian</a></div></div></body></html>'))
        return self.page_parts.select("page_id", "c_name", "n_name", "r_name", "text", "p1", "p2", html.alias("html"))

    @cached_property
    def index_pages(self) -> DataFrame:
        """One small index page per customer: metadata table and nested lists (a chain of
        lists, and a second list whose first anchor is not its own)."""
        html = F.concat(
            F.lit("<html><body><table><tr><th>Key:</th><td> K"), F.col("c_custkey").cast("string"),
            F.lit(" </td></tr><tr><th>Name</th><td>"), F.col("c_name"),
            F.lit("</td></tr><tr><th>Description</th><td>of <b>"), F.col("n_name"),
            F.lit("</b></td></tr><tr><td>alone</td></tr></table>"
                  '<a href="loose_10000000.html">loose</a><ul><li><a href="'),
            F.col("r_name"), F.lit('_10000001.html">'), F.col("r_name"), F.lit('</a><ul><li><a href="n_20000002.html"> '),
            F.col("n_name"), F.lit(' </a><ul><li><a href="c_30000003.html">'), F.col("c_name"),
            F.lit('</a></li></ul></li></ul><ul><li><a href="/plain">no</a><a href="b_20000004.html">B</a>'
                  '<ul><li><a href="d_30000005.html">D</a></li></ul></li></ul></li></ul></body></html>'))
        return (self.table("customer")
                .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .select(F.col("c_custkey").alias("page_id"), "c_name", "n_name", "r_name", html.alias("html")))
