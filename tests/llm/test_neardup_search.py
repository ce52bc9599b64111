"""The graph's search: entry nodes, early ends and links taken, against plain loops."""
import numpy as np

from pagewright.llm import neardup


def graph(n, dim=32):
    rng = np.random.default_rng(3)
    x = neardup.unit(rng.normal(size=(n, dim))).astype(np.float32)
    levels = np.sort(np.floor(-np.log(rng.random(n)) / np.log(neardup.DEGREE)).astype(int))[::-1]
    return neardup.Graph.build(x, levels), neardup.unit(rng.normal(size=(200, dim))).astype(np.float32)


def test_queries_enter_at_the_nearest_nodes_of_the_level_above():
    built, queries = graph(4000)
    n = built.sizes[1]
    assert neardup.STARTS < n <= neardup.SCANNED
    want = np.argsort(-(queries @ built.x[:n].T), axis=1)[:, :neardup.STARTS]
    assert (np.sort(built.descend(queries, 0), axis=1) == np.sort(want, axis=1)).all()


def test_levels_too_large_to_compare_are_searched_by_beams(monkeypatch):
    built, queries = graph(4000)
    monkeypatch.setattr(neardup, "SCANNED", 100)
    nearest = np.argmax(queries @ built.x[:built.sizes[1]].T, axis=1)
    assert np.mean([near in start for near, start in zip(nearest, built.descend(queries, 0))]) >= 0.9


def test_a_query_finds_the_same_nodes_alone_and_among_others():
    built, queries = graph(1500)
    ids, sims = built.beam(queries, 0, built.descend(queries, 0), 32)
    for i in range(0, len(queries), 20):
        one = queries[i:i + 1]
        alone, its = built.beam(one, 0, built.descend(one, 0), 32)
        assert set(alone[0]) == set(ids[i]) and np.allclose(its[0], sims[i], atol=1e-6)
    assert np.allclose(np.einsum("qd,qkd->qk", queries, built.x[ids]), sims, atol=1e-6) and (np.diff(sims, axis=1) <= 0).all()


def test_links_are_those_of_a_plain_loop():
    built, queries = graph(600)
    sims = queries @ built.x.T
    ids = np.argsort(-sims, axis=1)[:, :40]
    ids[::3, 30:] = -1
    sims = np.where(ids >= 0, np.take_along_axis(sims, np.maximum(ids, 0), 1), -2).astype(np.float32)
    for query, row, s, got in zip(queries, ids, sims, built.select(queries, ids, sims, 12)):
        kept = []
        for node, sim in zip(row, s):
            if node >= 0 and len(kept) < 12 and all(built.x[node] @ built.x[k] < sim for k in kept):
                kept.append(node)
        assert got.tolist() == (kept + [i for i in row if i >= 0 and i not in kept])[:12]


def test_a_node_that_none_links_to_is_found_from_its_own_links():
    x = neardup.unit(np.array([[1, 0.01 * i] for i in range(5)])).astype(np.float32)
    chain = neardup.Graph(x, [5], [np.array([[1, -1], [0, 2], [1, -1], [2, -1], [3, 0]])])
    assert sorted(chain.near(x[0], np.array([0]), np.float32(0.95))) == [0, 1, 2, 3, 4]
    assert sorted(chain.near(x[0], np.array([0]), x[0] @ x[2])) == [0, 1, 2]


def test_large_groups_are_found_whole_by_the_first_beam():
    rng = np.random.default_rng(2)
    groups = [rng.normal(size=64) + rng.normal(scale=0.1, size=(m, 64)) for m in (150, 300, 600)]
    x = neardup.unit(np.vstack([*groups, rng.normal(size=(3000, 64))]))
    x = x[rng.permutation(len(x))]
    levels = np.sort(np.floor(-np.log(rng.random(len(x))) / np.log(neardup.DEGREE)).astype(int))[::-1]
    built = neardup.Graph.build(x.astype(np.float32), levels)
    want = [int((row >= 0.95).sum()) for row in x @ x.T]
    got = [len(ids) for ids in neardup.links(built, x, x, 0.95, neardup.BEAM)]
    assert max(want) >= 600 and np.mean(np.array(got) / want) >= 0.999 and neardup.audit(built, x, x[:0], 0.95) == neardup.BEAM


def test_vectors_are_packed_without_loss():
    single = np.array([[0.5, -2.0], [1e-3, 7.0]], np.float32).astype(float)
    for raw in (single, np.array([[0.1, 1e300], [3.0, 1e-300]])):
        assert (neardup.unpacked(neardup.packed(raw)) == raw).all()
    assert len(neardup.packed(single)) < len(neardup.packed(np.array([[0.1, 0.2], [0.3, 0.4]])))
