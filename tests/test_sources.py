"""Files, archives, stored spaces and the incremental run."""
import io
import warnings
import zipfile

import pytest
from pyspark.sql import functions as F

from pagewright.operators import archives
from pagewright.session import scratch_path
from pagewright.sources import files, spaces, zips
from pagewright.streaming.resume import current_pages, resume_stream


@pytest.fixture
def export(tmp_path):
    for name, body in {"input/Export-1/IS/index.html": "<p>i</p>\n", "input/Export-1/IS/sub/A_12345678.html": "a",
                       "input/Export-1/GI/x.html": "x", "input/Old-2/ZZ/index.html": "z",
                       "input/Export-1/IS/attachments/12345678/f.png": "png"}.items():
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(body)
    return tmp_path


def test_folder_scans(spark, export):
    got = {r.path.split("input/")[1]: r.html for r in files.scan_pages(spark, str(export)).collect()}
    assert got["Export-1/IS/index.html"] == "<p>i</p>\n" and len(got) == 4
    listing = files.list_files(spark, str(export))
    assert [(r.export, r.folder) for r in files.discover_spaces(listing).collect()] == [("Export-1", "IS")]
    assert {r.export for r in files.list_exports(listing).collect()} == {"Export-1", "Old-2"}


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "Confluence-space-export-1.html.zip", "w") as z:
        z.writestr("IS/index.html", "héllo")
        z.writestr("../evil", "x")
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "no.zip").write_bytes(b"")
    found = files.scan_archives(spark, str(tmp_path))
    assert found.count() == 2
    members = files.scan_zip_members(found)
    summary = {r.folder_name: (r.success, r.files_extracted, r.files_blocked, r.error)
               for r in archives.extraction_summary(members).collect()}
    assert summary == {"Export-1": (True, 1, 1, None), "bad": (False, 0, 0, "Invalid or corrupted zip file")}
    content = files.read_zip_members(found, archives.admitted(members)).collect()
    assert [(r.member, bytes(r.content).decode()) for r in content] == [("IS/index.html", "héllo")]


def test_archives_that_are_empty_or_damaged(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    with zipfile.ZipFile(tmp_path / "part.zip", "w") as z:
        z.writestr("a.html", "good")
        z.writestr("b.html", "body-that-breaks")
    raw = (tmp_path / "part.zip").read_bytes()
    (tmp_path / "part.zip").write_bytes(raw.replace(b"body-that-breaks", b"body-that-differs"[:16]))
    found = files.scan_archives(spark, str(tmp_path))
    members = files.scan_zip_members(found)
    summary = {r.folder_name: (r.success, r.files_extracted) for r in archives.extraction_summary(members).collect()}
    assert summary == {"empty": (True, 0), "part": (True, 2)}
    read = {r.member: (r.content and bytes(r.content), r.error) for r in files.read_zip_members(found, archives.admitted(members)).collect()}
    assert read["a.html"] == (b"good", None)
    assert read["b.html"][0] is None and "CRC" in read["b.html"][1] and len(read) == 2


def test_space_json_of_any_depth(spark):
    text = ""
    for i in range(14, 0, -1):
        text = f'[{{"title": "t{i}", "children": {text or "[]"}}}, {{"title": "leaf{i}"}}]'
    docs = spaces.parse_space_json(spark.createDataFrame([(f'{{"space_key": "s", "space_content": {text}}}',)], "json string"))
    flat = spaces.flatten_space_json(docs.select("space_key", "space_content")).collect()
    assert len(flat) == 28 and max(r.depth for r in flat) == 14
    assert ["/".join(r.path) for r in flat if r.title == "leaf3"] == ["t1/t2/leaf3"]
    empty = spaces.parse_space_json(spark.createDataFrame([], "json string"))
    assert spaces.flatten_space_json(empty.select("space_key", "space_content")).count() == 0


def test_space_json(spark, tmp_path):
    (tmp_path / "is.json").write_text('{"space_name": "S",\n "space_key": "is", "space_content": [{"title": "r", "children": '
                                      '[{"title": "a", "children": []}, {"title": "b"}]}, {"title": "r2"}]}')
    docs = spaces.scan_space_json(spark, str(tmp_path))
    assert [r.file_key for r in docs.collect()] == ["is"]
    flat = spaces.flatten_space_json(docs)
    assert sorted(("/".join(r.path), r.depth) for r in flat.collect()) == [("r", 1), ("r/a", 2), ("r/b", 2), ("r2", 1)]
    asked = spark.createDataFrame([("is",), ("gi",)], "space_key string")
    assert [r.space_key for r in spaces.missing_keys(asked, docs).collect()] == ["gi"]
    assert [r.space_key for r in files.space_keys(files.list_files(spark, str(tmp_path))).collect()] == ["is"]


def test_children_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(spaces, "CHILDREN_PER_ROW", 2)
    df = spark.createDataFrame([("s", ["r"], 0)] + [("s", ["r", f"c{i}"], i) for i in range(1, 6)], "space_key string, path array<string>, pos long")
    rows = spaces.nest_space_json(df.selectExpr("*", "path[size(path) - 1] as title"), ["title"]).orderBy("parent_path", "chunk").collect()
    assert [(r.parent_path, r.chunk, r.children) for r in rows] == [
        ([], 0, '[{"title":"r"}]'), (["r"], 0, '[{"title":"c1"},{"title":"c2"}]'),
        (["r"], 1, '[{"title":"c3"},{"title":"c4"}]'), (["r"], 2, '[{"title":"c5"}]')]


def test_writing_a_space_replaces_only_that_space(spark, tmp_path):
    folder = str(tmp_path / "spaces")
    schema = "space_key string, title string"
    spaces.write_spaces(spark.createDataFrame([("a", "1"), ("b", "2")], schema), folder)
    spaces.write_spaces(spark.createDataFrame([("a", "9")], schema), folder)
    got = spaces.read_spaces(spark, folder, spark.createDataFrame([], schema).schema).collect()
    assert sorted((r.space_key, r.title) for r in got) == [("a", "9"), ("b", "2")]


def test_resume(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "page_id long, html string, at int"
    seen = []

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def step(df):
        seen.extend(r.page_id for r in df.select("page_id").collect())
        return df.selectExpr("page_id", "page_version", "length(html) as n")

    def run():
        seen.clear()
        resume_stream(spark, source, spark.createDataFrame([], schema).schema, state, target, step, order="at").awaitTermination()
        return sorted((tuple(r) for r in current_pages(spark, target).collect()), key=str)

    arrive((1, "a", 1), (2, "bb", 1), (4, "x", 1), (4, "xyz", 3), (4, "xy", 2), (4, "xyz", 4))
    first = [(1, 1, 1), (2, 1, 2), (4, 3, 3)]
    assert run() == first
    assert run() == first and seen == []
    arrive((1, "a", 2), (2, "changed", 2), (3, "ccc", 2), (None, None, 2), (None, "", 2))
    later = sorted([(1, 1, 1), (2, 2, 7), (3, 1, 3), (4, 3, 3), (None, 1, None)], key=str)
    got = run()
    assert sorted(seen, key=str) == [2, 3, None]  # a null content equals an empty one
    assert [r[:2] for r in got] == [r[:2] for r in later]
    arrive((2, "bb", 3))  # back to what it was: a change as well
    assert (2, 3, 2) in run()


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "page_id long, html string"
    spark.createDataFrame([(i, f"t{i}") for i in range(20)], schema).write.parquet(source)
    fails = [True]

    def step(df):
        if fails.pop() if fails else False:
            raise RuntimeError("lost")
        return df.select("page_id", "page_version", "html")

    for _ in range(2):
        query = resume_stream(spark, source, spark.createDataFrame([], schema).schema, state, target, step)
        try:
            query.awaitTermination()
        except Exception as error:
            assert "lost" in str(error)
    assert sorted(map(tuple, current_pages(spark, target).collect())) == [(i, 1, f"t{i}") for i in range(20)]


class Counting(io.FileIO):
    """A file that counts the bytes that are read from it."""

    count = 0

    def read(self, size=-1):
        data = super().read(size)
        self.count += len(data)
        return data


def test_a_directory_is_read_without_bodies(tmp_path):
    path = tmp_path / "big.zip"
    with zipfile.ZipFile(path, "w") as z:
        for i in range(50):
            z.writestr(f"m{i}", bytes(200_000))
    opened = Counting(path)
    rows = list(zips.directory("big.zip", path.stat().st_size, opened))
    assert len(rows) == 50 and all(r[3] == 200_000 for r in rows)
    assert opened.count < 0.05 * path.stat().st_size


def test_archive_source(spark, tmp_path, monkeypatch):
    def make(name, **members):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for member, body in members.items():
                z.writestr(member, body)

    make("a.zip", x="one", y="two" * 1000)
    make("empty.zip")
    make("broken.zip", good="fine", bad="B" * 50)
    raw = (tmp_path / "broken.zip").read_bytes()
    (tmp_path / "broken.zip").write_bytes(raw.replace(b"B" * 50, b"B" * 49 + b"C"))
    (tmp_path / "damaged.zip").write_bytes(b"PK no archive at all, but long enough to look for its end")
    (tmp_path / "short.zip").write_bytes(b"")
    (tmp_path / "other.txt").write_text("not listed")
    (tmp_path / "sub.zip").mkdir()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        with zipfile.ZipFile(tmp_path / "twice.zip", "w") as z:
            z.writestr("same", "first")
            z.writestr("same", "second")
    with zipfile.ZipFile(tmp_path / "many.zip", "w") as z:  # more entries than a plain directory can count: ZIP64
        for i in range(66_000):
            z.writestr(zipfile.ZipInfo(f"d/{i}"), b"")

    members = zips.scan_members(spark, str(tmp_path))
    by = {r.zip_file.split("/")[-1]: r for r in zips.scan_archives(spark, str(tmp_path)).collect()}
    assert {n: (r.members, r.error) for n, r in by.items()} == {
        "a.zip": (2, None), "empty.zip": (0, None), "broken.zip": (2, None), "twice.zip": (2, None), "many.zip": (66_000, None),
        "damaged.zip": (0, "Invalid or corrupted zip file"), "short.zip": (0, "Invalid or corrupted zip file")}
    assert all(r.archive_size == (tmp_path / n).stat().st_size for n, r in by.items())

    bodies = zips.read_members(members.where("zip_file NOT LIKE '%many.zip'")).collect()
    found = sorted((r.member, bytes(r.content) if r.content is not None else None) for r in bodies)
    assert found == [("bad", None), ("good", b"fine"), ("same", b"first"), ("same", b"second"), ("x", b"one"), ("y", b"two" * 1000)]
    assert [("Bad CRC" in r.error) for r in bodies if r.error] == [True]

    # one large archive is read by several tasks, each from its own places
    spread = zips.read_members(members.where("zip_file LIKE '%many.zip'")).withColumn("task", F.spark_partition_id())
    found = spread.groupBy("task").count().collect()
    assert sum(r["count"] for r in found) == 66_000 and len(found) > 1

    reader = zips.ZipReader({"path": str(tmp_path)})
    monkeypatch.setattr(zips, "LIST_FILES", 3)
    parts = reader.partitions()
    assert [len(p.files) for p in parts] == [3, 3, 1]
    (tmp_path / "sub.zip" / "deeper").mkdir()
    assert zips.scan_members(spark, str(tmp_path / "sub.zip")).count() == 0


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert base is None or path.startswith(base)
    assert path != scratch_path(spark, "x")
