"""One file a page is written by many tasks."""
import os

from pagewright.plans import q_sources, registry


def test_page_files_are_written_by_many_tasks(spark, monkeypatch, tmp_path):
    spark.range(60).selectExpr("id AS page_id", "concat('<p>', id, '</p>') AS html").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    folder = f"{tmp_path}/export"
    monkeypatch.setattr(q_sources, "scratch_path", lambda *_: folder)
    assert registry.queries()["scan_pages"](spark, str(tmp_path)).distinct().count() == 60
    names = [n for n in os.listdir(folder) if n.endswith(".txt")]
    assert len(names) == 60 and len({n.split("-")[1] for n in names}) > 1
