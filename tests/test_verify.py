"""The remote tree against the items: moved pages, missing files and changed texts are told apart."""
from pagewright.operators import sync

ITEM = "space_key string, path array<string>, parent_path array<string>, pos int, page_id string, page_uuid string, parent_uuid string, md_content string"


def test_differences_are_told_apart(spark):
    paths = [("r",), ("r", "a"), ("r", "a", "b"), ("r", "a", "c"), ("r", "d"), ("r", "d", "e"), ("r", "d", "f"), ("r", "g"), ("o",), ("o", "p")]
    uuid = {p: "id-" + p[-1] for p in paths} | {("r", "d", "f"): None}
    items = spark.createDataFrame([("s", list(p), list(p[:-1]) or None, i, f"page-{p[-1]}", uuid[p], None, None if p == ("r", "g") else f"text {p[-1]}")
                                   for i, p in enumerate(paths)], ITEM)
    remote = spark.createDataFrame([
        ("id-a", None, "text a"), ("id-b", "id-a", "changed"), ("id-c", "id-d", "text c"), ("id-d", None, "text d"),
        ("id-g", None, None), ("id-o", None, "text o"), ("id-p", "id-o", "text p"), ("id-x", None, "no item"), (None, None, "no id")],
        "id string, parent_id string, text string")
    listed = spark.createDataFrame([("page-p", "1.png"), ("page-p", "2.png"), ("page-p", "2.png"), ("page-a", "3.png")], "page_id string, path string")
    details = spark.createDataFrame([("page-p", "1.png", True), ("page-p", "2.png", False), ("page-a", "3.png", True)],
                                    "page_id string, path string, uploaded boolean")
    got = {"/".join(r.path) if r.path else r.id: (r.content, r.moved, r.missing_files, r.below)
           for r in sync.verify_tree(items, remote, listed, details).collect()}
    assert got == {
        "r/a": ("equal", False, 0, 2), "r/a/b": ("changed", False, 0, 1), "r/a/c": ("equal", True, 0, 1),
        "r/d": ("equal", False, 0, 2), "r/d/e": ("missing", False, 0, 1), "r/d/f": ("not uploaded", False, 0, 1), "r/g": ("equal", False, 0, 0),
        "o": ("equal", False, 0, 1), "o/p": ("equal", False, 1, 1), "id-x": ("extra", False, 0, 0), None: ("extra", False, 0, 0)}
    assert sync.verify_tree(items.limit(0), remote.limit(0), listed, details).count() == 0
