"""Tasks and batches that follow the data."""
from pyspark.sql import functions as F

from pagewright.operators import dom
from pagewright.session import configure


def test_pages_are_not_dealt_to_a_fixed_number_of_tasks(spark, capsys):
    pages = spark.createDataFrame([(1, "<p>a</p>"), (None, "<p>b</p>")], "page_id long, html string")
    dom.html_tokens(pages).explain()
    plan = capsys.readouterr().out
    assert "REPARTITION_BY_COL" in plan and "REPARTITION_BY_NUM" not in plan


def test_tasks_of_pages_have_little_source_each(spark):
    configure(spark)
    noise = F.expr("array_join(transform(sequence(1, 600), i -> sha2(cast(id * 1000 + i as string), 512)), ' ')")
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.concat(F.lit("<p>"), noise).alias("html"))  # 46 MB
    tokens = dom.html_tokens(pages)
    assert tokens.select(F.spark_partition_id()).distinct().count() > 16
    configure(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_pages_reach_python_in_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    configure(spark)

    def sizes(batches):
        for b in batches:
            yield b.iloc[:1].assign(id=len(b))

    found = spark.range(2000, numPartitions=1).mapInPandas(sizes, "id long").collect()
    assert max(r.id for r in found) <= 256 and sum(r.id for r in found) == 2000


def test_pages_are_sorted_four_times_and_their_code_is_compiled(spark, capsys):
    pages = spark.createDataFrame([(1, "<body><div id='footer'>a</div><p>b</p></body>")], "page_id long, html string")
    dom.html_to_markdown(pages).explain()
    plan = capsys.readouterr().out
    # by name, by name and depth, by place, by list; the aggregate takes pages as they come
    assert plan.count("Sort [") == 4 and "ObjectHashAggregate" not in plan
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    configure(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"


def test_only_the_first_footer_of_a_page_is_cut_and_blanks_are_one(spark):
    foot = '<div id="footer">{}</div>'
    rows = [(1, f"<body>a{foot.format('x')}<p> \t </p><p>b \t c\n d  e f</p>{foot.format('y')}</body>"),
            (2, f"<body>{foot.format('z')}</body>"), (None, f"<body>{foot.format('x')}{foot.format('n')}</body>")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    got = {r.page_id: r.markdown for r in dom.html_to_markdown(pages).collect()}
    assert got == {1: "a\n\nb c d e f\n\ny", 2: "", None: "n"}
    rows = [(i, t) for i, t in enumerate(["a ", " \t", " ", "", "\n x"])]
    kept = dom.drop_empty_blocks(dom.match_tags(dom.html_tokens(
        spark.createDataFrame([(i, f"<p>{t}</p>") for i, t in rows], "page_id long, html string"))))
    assert {r.page_id for r in kept.where("name = 'p'").collect()} == {0, 4}
