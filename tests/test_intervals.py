"""Subtrees as intervals, and the checks of a dry run."""
import collections
import random

from pagewright.operators import sync, tree

NODE = "space_key string, path array<string>"


def test_sizes_and_intervals_of_deep_wide_and_odd_trees(spark):
    rnd = random.Random(3)
    paths = {("s", tuple(f"n{i}" for i in range(d))) for d in range(1, 201)}                  # depth 200
    paths |= {("s", ("n0", f"kid {i}")) for i in range(3000)}                                  # a parent with many children
    paths |= {("t", tuple(rnd.choice(["a", "a b", "", "\U0010ffff", "é", "a\x00"]) for _ in range(rnd.randint(1, 6)))) for _ in range(400)}
    paths |= {(None, ("x",)), (None, ("x", "y"))}
    nodes = spark.createDataFrame([(s, list(p)) for s, p in paths], NODE).repartition(5)
    sizes = collections.Counter((s, p[:k]) for s, p in paths for k in range(1, len(p) + 1))
    got = {(r.space_key, tuple(r.path)): r["items"] for r in tree.subtree_sizes(nodes).collect()}
    assert got == {k: n for k, n in sizes.items() if k in paths}
    label = {(r.space_key, tuple(r.path)): (r.first, r.last) for r in tree.intervals(nodes).collect()}
    for key in rnd.sample(sorted(paths, key=str), 40):
        inside = {k for k in paths if k[0] == key[0] and label[key][0] <= label[k][0] <= label[key][1]}
        assert inside == {k for k in paths if k[0] == key[0] and k[1][:len(key[1])] == key[1]}
    plan = tree.subtree_sizes(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and tree.subtree_sizes(nodes.limit(0)).count() == 0


def test_items_below_failed_creates_are_left_out(spark):
    rnd = random.Random(4)
    paths = {tuple(rnd.choice("abc") for _ in range(rnd.randint(1, 7))) for _ in range(300)}
    failed = set(rnd.sample(sorted(paths), 12)) | {("b", "not an item")}
    items = spark.createDataFrame([("s", list(p), list(p[:-1])) for p in paths], NODE + ", parent_path array<string>")
    bad = spark.createDataFrame([("s", list(p)) for p in failed] * 2 + [("other", ["a"])], NODE)
    got = {tuple(r.path) for r in sync.attempted_items(items, bad).collect()}
    assert got == {p for p in paths if not any(p[:k] in failed for k in range(1, len(p)))}
    assert sync.attempted_items(items, bad.limit(0)).count() == len(paths)


def test_each_check_has_a_failing_and_a_passing_row(spark):
    item = "space_key string, path array<string>, parent_path array<string>, title string, type string, href string, html_page string, page_id string, extra int"
    row = lambda path, title="fine", type="collection", href="h.html", page="h.html", space="s", pid=None: (
        space, path, path[:-1] or None, title, type, href, page, pid, 1)
    items = spark.createDataFrame([
        row(["r"]), row(["r", "ok"], type="page", pid="1"), row(["r", "blank"], title=" "), row(["r", "none"], title=None),
        row(["r", "long"], title="x" * 256), row(["r", "edge"], title="x" * 255), row(["gone", "orphan"]), row(["r", "twice"]),
        row(["r", "twice"]), row(["r", "lost"], type="page", page=None), row(["u"], space="u"), row(["v"], space="v")], item)
    spaces = spark.createDataFrame([("s", "S", None), ("u", " ", None), ("v", None, "col")], "space_key string, space_name string, collection_id string")
    listed = spark.createDataFrame([("1", "a.png"), ("1", "b.png"), ("1", "b.png"), ("9", "c.png")], "page_id string, path string")
    files = spark.createDataFrame([("1", "a.png"), ("2", "b.png")], "page_id string, path string")
    got = collections.Counter(("/".join(r.path), r.rule, r.detail) for r in sync.dry_run_violations(items, spaces, listed, files).collect())
    assert got == {("r/blank", "blank title", None): 1, ("r/none", "blank title", None): 1, ("r/long", "long title", "256"): 1,
                   ("gone/orphan", "orphan", "gone"): 1, ("r/twice", "repeated path", "2"): 2, ("r/lost", "page without file", "h.html"): 1,
                   ("u", "unknown space", "u"): 1, ("r/ok", "missing file", "b.png"): 1}
    assert sync.dry_run_violations(items.limit(0), spaces, listed, files).count() == 0
