"""Beams are searched on every table, and an audit refuses those that lose links."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import neardup


class Blind(neardup.Graph):
    """A graph whose search never reaches the nodes from ``self.hidden`` on."""

    def beam(self, queries, level, start, width):
        ids, sims = super().beam(queries, level, start, width)
        return ids, np.where(ids >= self.hidden, -2, sims)

    def near(self, query, start, least):
        return np.flatnonzero(self.x[:self.hidden] @ query >= least)

    def descend(self, queries, level):
        return np.zeros((len(queries), 1), np.int64)


def table(dense, sparse, dim=64):
    rng = np.random.default_rng(8)
    group = rng.normal(size=dim) + rng.normal(scale=0.05, size=(dense, dim))
    return neardup.unit(np.vstack([group, rng.normal(size=(sparse, dim))])), rng


def brute(x, queries):
    return [list(np.flatnonzero(row >= 0.95)) for row in queries @ x.T]


@pytest.mark.parametrize("dense, sparse", [(600, 1200), (1, 2000)])
def test_audit_refuses_a_graph_that_hides_nodes(dense, sparse):
    x, rng = table(dense, sparse)
    graph = Blind(x.astype(np.float32), [len(x)], [np.tile(np.arange(24), (len(x), 1))])
    graph.hidden = dense
    sample = neardup.unit(rng.normal(size=(300, 64)))  # none of them has a link
    assert neardup.audit(graph, x, sample, 0.95) is None
    queries = neardup.unit(x[::7] + rng.normal(scale=0.01, size=x[::7].shape))
    assert [sorted(g) for g in neardup.links(graph, x, queries, 0.95, None)] == brute(x, queries)


@pytest.mark.parametrize("dense, sparse", [(0, 3000), (1000, 2000)])
def test_a_sound_graph_is_searched_by_beams(dense, sparse):
    x, rng = table(dense, sparse)
    x = x[rng.permutation(len(x))]
    levels = np.sort(np.floor(-np.log(rng.random(len(x))) / np.log(neardup.DEGREE)).astype(int))[::-1]
    graph = neardup.Graph.build(x.astype(np.float32), levels)
    graph = neardup.Graph.load(graph.dump(), graph.x)
    width = neardup.audit(graph, x, x[:0], 0.95)
    assert width and width <= len(x) // 4
    queries = neardup.unit(x[::5] + rng.normal(scale=0.02, size=x[::5].shape))
    want = brute(x, queries)
    got = [set(g) for g in neardup.links(graph, x, queries, 0.95, width)]
    assert all(g <= set(w) for g, w in zip(got, want))
    assert sum(map(len, got)) >= 0.98 * sum(map(len, want))


def test_near_copies_have_the_link_they_were_made_for():
    x, _ = table(50, 400)
    assert ((neardup.near_copies(x, 200, 0.95) @ x.T).max(axis=1) >= 0.95).all()
    assert len(neardup.near_copies(np.ones((1, 1)), 5, 0.95)) == 1


def test_different_vectors_of_one_id_are_nodes_of_their_own(spark):
    one, two = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, one), (1, two), (2, [1.0, 0.01, 0.0]), (3, [0.01, 1.0, 0.0]), (None, two)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(((r.vec_id or 0), r.n_links, r.component_id) for r in got.collect()) == \
        [(0, 2, 1), (1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1)]


def test_the_given_table_gives_the_links_of_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").dropDuplicates(["vec_id"])
    data = [(r.vec_id, r.embedding) for r in rows.where(F.col("embedding").isNotNull()).collect()]
    x = neardup.unit(np.array([v for _, v in data], float))
    want = {i: int((row >= 0.95).sum()) - 1 for (i, _), row in zip(data, x @ x.T)}
    got = {r.vec_id: r.n_links for r in neardup.near_duplicates(rows).collect()}
    assert sum(abs(got[i] - n) for i, n in want.items()) <= 0.01 * sum(want.values())
