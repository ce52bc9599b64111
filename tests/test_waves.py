"""Waves run to the end over outcome tables."""
from pyspark.sql import functions as F

from pagewright.operators import status, sync


def table(spark, paths, created=()):
    rows = [("s", list(p), list(p[:-1]) or None, i, f"old-{i}" if p in created else None, None, p in created) for i, p in enumerate(paths)]
    return spark.createDataFrame(rows, "space_key string, path array<string>, parent_path array<string>, pos int, page_uuid string, "
                                       "parent_uuid string, created boolean")


def outcomes(spark, paths, failed=()):
    return spark.createDataFrame([("s", list(p), None if p in failed else "id-" + "".join(p), p not in failed) for p in paths],
                                 "space_key string, path array<string>, page_uuid string, created boolean")


def spaces(spark, home="home"):
    return spark.createDataFrame([("s", home)], "space_key string, collection_id string")


def states(df):
    return {"/".join(r.path): (r.upload_state, r.page_uuid, r.parent_uuid, r.created) for r in df.collect()}


def test_any_depth_ends_with_all_created(spark):
    chain = [("r", *["n"] * i) for i in range(9)] + [("other",), ("other", "x"), ("other", "x", "y")]
    items = table(spark, chain)
    got = sync.run_waves(items, spaces(spark), outcomes(spark, chain))
    assert status.upload_status(got).first().upload_successful
    by = states(got)
    assert by["r"] == ("created", "home", None, True)
    assert by["r/n"] == ("created", "id-rn", None, True)            # a child of the space page is top level
    assert by["r/n/n"] == ("created", "id-rnn", "id-rn", True)
    assert by["other/x"] == ("created", "id-otherx", "id-other", True)


def test_a_failed_create_leaves_just_its_subtree_out(spark):
    paths = [("r",), ("r", "a"), ("r", "a", "b"), ("r", "a", "b", "c"), ("r", "d"), ("r", "d", "e"), ("r", "f"), ("r", "f", "g")]
    asked = [p for p in paths if p != ("r", "f")]  # no outcome for f yet
    by = states(sync.run_waves(table(spark, paths), spaces(spark), outcomes(spark, asked, failed=[("r", "a")])))
    assert {k: v[0] for k, v in by.items()} == {
        "r": "created", "r/a": "failed", "r/a/b": "not attempted", "r/a/b/c": "not attempted", "r/d": "created", "r/d/e": "created",
        "r/f": "pending", "r/f/g": "not attempted"}
    assert by["r/a"][3] is False and by["r/a/b"][1] is None and by["r/d/e"][2] == "id-rd"


def test_a_failed_update_keeps_the_page_and_its_children_run(spark):
    paths = [("r",), ("r", "a"), ("r", "a", "b"), ("r", "k"), ("r", "k", "l")]
    items = table(spark, paths, created=[("r", "a"), ("r", "k")])
    by = states(sync.run_waves(items, spaces(spark), outcomes(spark, [("r", "a"), ("r", "a", "b"), ("r", "k", "l")], failed=[("r", "a")])))
    assert by["r/a"][:2] == ("created", "old-1") and by["r/a/b"][:3] == ("created", "id-rab", "old-1")
    assert by["r/k"][:2] == ("created", "old-3") and by["r/k/l"][2] == "old-3"


def test_a_second_run_goes_on_where_the_first_ended(spark):
    paths = [("r",), ("r", "a"), ("r", "a", "b"), ("r", "c")]
    first = sync.run_waves(table(spark, paths), spaces(spark), outcomes(spark, paths, failed=[("r", "a")]))
    assert not status.upload_status(first).first().upload_successful
    second = sync.run_waves(first, spaces(spark), outcomes(spark, [("r", "a"), ("r", "a", "b")]))
    assert status.upload_status(second).first().upload_successful
    assert states(second)["r/c"][1] == "id-rc"


def test_without_a_collection_or_items(spark):
    items = table(spark, [("r",), ("r", "a")])
    by = states(sync.run_waves(items, spaces(spark, None), outcomes(spark, [("r", "a")])))
    assert by["r"][0] == "pending" and by["r/a"][0] == "created"
    none = items.limit(0)
    assert sync.run_waves(none, spaces(spark), outcomes(spark, [("r", "a")])).count() == 0
    assert sync.run_waves(items.withColumn("path", F.col("path")), spaces(spark), outcomes(spark, [("z",)]).limit(0)).where("created").count() == 1
