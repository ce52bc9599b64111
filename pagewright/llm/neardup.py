"""Embedding near-duplicates: one navigable small-world graph per shard, every shard queried."""
from __future__ import annotations

import io
import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import stage
from pagewright.llm.components import components

COSINE = 0.95
LEAST_SHARDS = 4
SHARD_BYTES = 64 << 20   # of vectors in a shard, about
LEAST_BLOCKS = 4
BLOCK_BYTES = 32 << 20   # of queries that one task puts to one shard, about
DEGREE = 12              # links of a node on upper levels; twice as many on the lowest
BUILD_BEAM = 40
BEAM = 32                # width at first; doubled until the audit passes
UPPER, STARTS = 24, 8    # beam on upper levels, and what of it enters the next one
CHUNK = 512              # queries searched side by side
EXPAND = 4               # beam members expanded in one step
SCANNED = 1 << 14        # nodes of an upper level that are compared whole; larger levels are searched by beams
AUDITED = 1024           # nodes, drawn from all blocks, that audit every shard
COPIED = 512             # near copies of its own nodes that audit a shard as well
SPARSE = 8               # shuffle partitions for each group of vectors, so that few groups share one
FEW = 8                  # links of a query; those of more are audited apart
RECALL = 0.99            # least share of its links that an audited query must find, on average


class Graph:
    """Nodes are ordered by level, so those of a level are a prefix; links are padded by -1."""

    def __init__(self, vectors: np.ndarray, sizes: list[int], links: list[np.ndarray]):
        self.x, self.sizes, self.links = vectors, sizes, links

    def sims(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Similarities of each query with its nodes (q, k); only nodes that are there are fetched."""
        there = ids >= 0
        found = np.full(ids.shape, -2, np.float32)
        found[there] = np.einsum("kd,kd->k", np.repeat(queries, there.sum(axis=1), axis=0), self.x.take(ids[there], axis=0))
        return found

    def beam(self, queries: np.ndarray, level: int, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` nodes that a beam search from ``start`` (q, s) reaches, best first."""
        q, links = len(queries), self.links[level]
        best_ids, best_sims = np.full((q, width), -1, np.int64), np.full((q, width), -2, np.float32)
        rows = np.arange(q)  # queries with nodes to expand; the others leave the arrays
        ids, sims = start.copy(), self.sims(queries, start)
        seen = np.zeros((q, self.sizes[level] + 1), bool)  # the last column stands for no node
        seen[rows[:, None], ids] = True
        seen[:, -1] = True
        done = np.zeros(ids.shape, bool)
        while True:
            open_sims = np.where(done, -3, sims)
            k = min(EXPAND, ids.shape[1])
            pick = np.argpartition(-open_sims, k - 1, axis=1)[:, :k] if k < ids.shape[1] else np.tile(np.arange(k), (len(rows), 1))
            live = np.take_along_axis(open_sims, pick, 1) > -2
            busy = live.any(axis=1)
            if not busy.all():
                over = ~busy
                best_ids[rows[over], :ids.shape[1]], best_sims[rows[over], :ids.shape[1]] = ids[over], sims[over]
                rows, ids, sims, done, pick, live = (a[busy] for a in (rows, ids, sims, done, pick, live))
                if not len(rows):
                    break
            np.put_along_axis(done, pick, True, 1)
            near = np.where(live, np.take_along_axis(ids, pick, 1), -1)
            new = np.where((near >= 0)[:, :, None], links[np.maximum(near, 0)], -1).reshape(len(rows), -1)
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new[seen[rows[:, None], new]] = -1
            new = np.sort(new, axis=1)[:, new.shape[1] - (new >= 0).sum(axis=1).max():]
            seen[rows[:, None], new] = True
            ids = np.concatenate([ids, new], 1)
            sims = np.concatenate([sims, self.sims(queries[rows], new)], 1)
            done = np.concatenate([done, new < 0], 1)
            if ids.shape[1] > width:
                best = np.argpartition(-sims, width - 1, axis=1)[:, :width]
                ids, sims, done = (np.take_along_axis(a, best, 1) for a in (ids, sims, done))
        order = np.argsort(-best_sims, axis=1)
        return np.take_along_axis(best_ids, order, 1), np.take_along_axis(best_sims, order, 1)

    def descend(self, queries: np.ndarray, level: int) -> np.ndarray:
        """Near nodes of the level above for each query: the nearest of the lowest level that can be
        compared whole, and from there by beams."""
        start = np.zeros((len(queries), 1), np.int64)
        for above in range(len(self.links) - 1, level, -1):
            if above - 1 > level and self.sizes[above - 1] <= SCANNED:
                continue
            n = self.sizes[above]
            if STARTS < n <= SCANNED:
                start = np.argpartition(queries @ -self.x[:n].T, STARTS - 1, axis=1)[:, :STARTS]
            else:
                start = self.beam(queries, above, start, UPPER)[0][:, :STARTS]
        return start

    def select(self, queries: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
        """Links: first candidates nearer to the query than to any link taken, then the nearest."""
        valid = ids >= 0
        wide = int(valid.sum(axis=1).max()) if (np.diff(valid.astype(np.int8), axis=1) <= 0).all() else ids.shape[1]
        ids, sims, valid = ids[:, :wide], sims[:, :wide], valid[:, :wide]
        x = self.x.take(np.maximum(ids, 0), axis=0)
        mutual = x @ x.swapaxes(1, 2)
        kept, n = np.zeros(ids.shape, bool), np.zeros(len(ids), int)
        taken = np.full(ids.shape, -2, np.float32)  # similarity of a candidate with the nearest link taken
        for j in range(wide):
            take = valid[:, j] & (taken[:, j] < sims[:, j]) & (n < degree)
            kept[:, j] = take
            n += take
            np.maximum(taken, mutual[:, j], out=taken, where=take[:, None])
        rank = np.argsort(np.where(kept, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :degree]
        out = np.take_along_axis(ids, rank, 1)
        return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)

    def insert(self, level: int, first: int, last: int) -> None:
        """Link nodes first..last-1 to the nodes before them and to one another."""
        links, degree = self.links[level], self.links[level].shape[1]
        batch = np.arange(first, last)
        queries = self.x[first:last]
        inner = queries @ queries.T
        np.fill_diagonal(inner, -2)
        k = min(degree, len(batch) - 1)
        ids = np.full((len(batch), 1), -1, np.int64)
        sims = np.full((len(batch), 1), -2, np.float32)
        if k > 0:
            near = np.argpartition(-inner, k - 1, axis=1)[:, :k]
            ids, sims = np.concatenate([ids, near + first], 1), np.concatenate([sims, np.take_along_axis(inner, near, 1)], 1)
        if first:
            found = self.beam(queries, level, self.descend(queries, level), BUILD_BEAM)
            ids, sims = np.concatenate([ids, found[0]], 1), np.concatenate([sims, found[1]], 1)
        order = np.argsort(-sims, axis=1)[:, :BUILD_BEAM]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        links[first:last] = self.select(queries, ids, sims, degree)
        # links back, at most as many new ones for a node as it may have
        to, source = links[first:last].ravel(), np.repeat(batch, degree)
        source, to = source[to >= 0], to[to >= 0]
        order = np.lexsort((-np.einsum("kd,kd->k", self.x[to], self.x[source]), to))
        source, to = source[order], to[order]
        nodes, begin = np.unique(to, return_index=True)
        place = np.arange(len(to)) - np.repeat(begin, np.diff(np.append(begin, len(to))))
        fits = place < degree
        extra = np.full((len(nodes), degree), -1, np.int64)
        extra[np.searchsorted(nodes, to[fits]), place[fits]] = source[fits]
        both = np.concatenate([links[nodes], extra], 1)
        both = np.sort(both, axis=1)[:, ::-1]
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        for i in range(0, len(nodes), CHUNK):
            part, own = both[i:i + CHUNK], nodes[i:i + CHUNK]
            sims = self.sims(self.x[own], part)
            order = np.argsort(-sims, axis=1)
            links[own] = self.select(self.x[own], np.take_along_axis(part, order, 1), np.take_along_axis(sims, order, 1), degree)

    @classmethod
    def build(cls, vectors: np.ndarray, levels: np.ndarray) -> Graph:
        """``levels`` must fall; upper levels are finished before lower ones use them."""
        sizes = [int((levels >= level).sum()) for level in range(int(levels.max()) + 1)]
        links = [np.full((n, DEGREE * (1 if level else 2)), -1, np.int64) for level, n in enumerate(sizes)]
        graph = cls(vectors, sizes, links)
        for level in range(len(sizes) - 1, -1, -1):
            graph.links = [*links]
            first, n = 0, sizes[level]
            while first < n:
                last = min(n, first + min(CHUNK, max(first, 64)))
                graph.insert(level, first, last)
                first = last
        return graph

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f"l{i}": links.astype(np.int32) for i, links in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes, vectors: np.ndarray) -> Graph:
        data = np.load(io.BytesIO(raw))
        links = [data[f"l{i}"].astype(np.int64) for i in range(len(data.files))]
        return cls(vectors, [len(l) for l in links], links)

    @cached_property
    def back(self) -> tuple[np.ndarray, np.ndarray]:
        """The lowest level's links by the node they lead to: those that lead to node i are sources
        begin[i] to begin[i + 1]."""
        to = self.links[0].ravel()
        order = np.argsort(to, kind="stable")
        order = order[np.count_nonzero(to < 0):]
        return order // self.links[0].shape[1], np.searchsorted(to[order], np.arange(len(self.links[0]) + 1))

    def near(self, query: np.ndarray, start: np.ndarray, least: float) -> np.ndarray:
        """All nodes of at least a similarity that are reached from ``start`` through such nodes, along
        links in either direction: a node that no other one links to has links of its own."""
        source, begin = self.back
        found = frontier = start
        while len(frontier):
            first, n = begin[frontier], begin[frontier + 1] - begin[frontier]
            place = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            new = np.unique(np.concatenate([self.links[0][frontier].ravel(), source[place]]))
            new = np.setdiff1d(new[new >= 0], found, assume_unique=True)
            frontier = new[self.x[new] @ query >= least]
            found = np.concatenate([found, frontier])
        return found


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def packed(raw: np.ndarray) -> bytes:
    """Vectors in single precision, if it holds them exactly, or double; as bytes that ``unpacked`` reads."""
    with np.errstate(over="ignore"):
        small = raw.astype(np.float32)
    out = io.BytesIO()
    np.save(out, small if np.array_equal(small, raw) else raw)
    return out.getvalue()


def unpacked(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data)).astype(np.float64)


def links(graph: Graph, exact: np.ndarray, queries: np.ndarray, least: float,
          width: int | None) -> Iterator[np.ndarray]:
    """For each query the positions whose cosine with it reaches ``least``, verified in double
    precision. A beam of ``width`` finds first ones, links of links are followed from there;
    without a width all nodes are compared."""
    margin = np.float32(least - 1e-4)
    small = queries.astype(np.float32)
    for i in range(0, len(queries), CHUNK):
        chunk = small[i:i + CHUNK]
        if width is None:
            found = (np.flatnonzero(row >= margin) for row in chunk @ graph.x.T)
        else:
            ids, sims = graph.beam(chunk, 0, graph.descend(chunk, 0), width)
            found = (graph.near(query, row[s >= margin], margin) if s[0] >= margin else row[:0]
                     for query, row, s in zip(chunk, ids, sims))
        for query, ids in zip(queries[i:i + CHUNK], found):
            yield ids[exact[ids] @ query >= least] if len(ids) else ids


def near_copies(vectors: np.ndarray, n: int, least: float) -> np.ndarray:
    """Drawn vectors turned by a random angle, so that each has a link by construction: its
    cosine with the vector it was made from lies between ``least`` and 1, evenly."""
    rng = np.random.default_rng(len(vectors))
    base = vectors[rng.choice(len(vectors), min(n, len(vectors)), replace=False)]
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(axis=1, keepdims=True) * base
    length = np.linalg.norm(away, axis=1, keepdims=True)
    away = np.divide(away, length, out=np.zeros_like(away), where=length > 1e-9)
    cosine = rng.uniform(least + 1e-3 * (1 - least), 1, (len(base), 1))
    return unit(cosine * base + np.sqrt(1 - cosine ** 2) * away)


def audit(graph: Graph, exact: np.ndarray, sample: np.ndarray, least: float) -> int | None:
    """The width of beam for a shard: doubled from ``BEAM`` on until the audit queries find
    ``RECALL`` of the links that a comparison with all nodes gives them, each query counting
    alike. Apart from one another are judged: drawn nodes of other shards with few links here,
    those with many, and near copies of nodes, which have links even where the table has none.
    None, for comparing all nodes, if a beam of a quarter of the shard still fails."""
    copies = near_copies(exact, COPIED, least)
    queries = np.concatenate([sample, copies])
    true = np.array([len(ids) for ids in links(graph, exact, queries, least, None)])
    drawn = np.arange(len(queries)) < len(sample)
    groups = [np.flatnonzero(g) for g in (drawn & (true > 0) & (true <= FEW), drawn & (true > FEW), ~drawn)]
    width = BEAM
    while width <= max(BEAM, len(exact) // 4):
        found = np.array([len(ids) for ids in links(graph, exact, queries, least, width)])
        share = found / np.maximum(true, 1)
        if all(share[g].mean() >= RECALL for g in groups if len(g)):
            return width
        width *= 2
    return None


def _build(cell: pd.DataFrame, sample: pd.DataFrame) -> pd.DataFrame:
    """One audited graph; a node's level follows from its place, so a rerun gives the same graph."""
    if cell.empty:
        return pd.DataFrame({c: [] for c in ("dim", "shard", "width", "graph", "nodes", "raw", "copies")})
    cell = cell.sort_values(["place", "node"], ignore_index=True)
    draw = np.random.default_rng(len(cell)).random(len(cell))
    levels = np.floor(-np.log(np.maximum(draw, 1e-12)) / math.log(DEGREE)).astype(int)
    order = np.argsort(-levels, kind="stable")
    raw = np.array([v for v in cell["v"].iloc[order]], np.float64)
    exact = unit(raw)
    graph = Graph.build(exact.astype(np.float32), levels[order])
    nodes = cell["node"].to_numpy()[order]
    foreign = [v for v in sample["v"][~sample["node"].isin(nodes)]]
    width = audit(graph, exact, unit(np.array(foreign, np.float64)) if foreign else exact[:0], COSINE)
    return pd.DataFrame({"dim": cell["dim"].iloc[:1], "shard": cell["shard"].iloc[:1],
                         "width": pd.array([width], "Int32"), "graph": [graph.dump()], "nodes": [nodes.tobytes()],
                         "raw": [packed(raw)], "copies": [cell["copies"].to_numpy()[order].tobytes()]})


def _query(block: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
    """Per query the number of links in the shard, and edges that join what the links found join:
    one from each query to a node, and one between nodes for each two groups that a query unites."""
    if block.empty or cell.empty:
        return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
    row = cell.iloc[0]
    nodes, copies = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["copies"], np.int64)
    exact = unit(unpacked(row["raw"]))
    graph = Graph.load(row["graph"], exact.astype(np.float32))
    width = None if pd.isna(row["width"]) else int(row["width"])
    queries = unit(np.array([v for v in block["v"]], np.float64))
    parent = np.arange(len(nodes))  # of each node; roots are their own

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    a, b, n = [], [], []
    for key, ids in zip(block["node"].tolist(), links(graph, exact, queries, COSINE, width)):
        ids = ids[nodes[ids] != key]
        if not len(ids):
            continue
        tops = sorted({top(x) for x in np.unique(parent[ids]).tolist()})
        a += [key, *nodes[tops[1:]].tolist()]
        b += nodes[tops[:1]].tolist() * len(tops)
        n += [int(copies[ids].sum())] + [0] * (len(tops) - 1)
        parent[tops] = parent[ids] = tops[0]
    return pd.DataFrame({"a": a, "b": b, "n": n}).astype("int64")


def _grouped(df: DataFrame, key: list[str], groups: int):
    """Rows grouped by ``key``, most groups in a task of their own: small ones take long too, and
    a count that is asked for is not joined by AQE."""
    return df.repartition(SPARSE * groups, *key).groupBy(*key)


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept (vec_id = component_id).

    Vectors with equal components are one node with so many copies, and a key of its own, so
    different vectors of one id stay apart. Nodes are hashed to shards of a bounded size, each
    with its own graph; all nodes query every shard, in blocks about as large as a shard. A beam
    search finds a first link and links of links are followed. The beam's width is chosen once
    for each shard, as the graph is built, by an audit against brute force (see ``audit``): at
    most ``AUDITED`` nodes drawn from the table and ``COPIED`` near copies of its own. Every link
    is verified in double precision. A task returns counts and edges that span the groups, not
    the pairs, so a dense group of m vectors costs m rows per shard. Components are joined over
    all shards.

    Null and zero vectors, and those with null, infinite or undefined components, link with
    nothing; vectors of another length only with their like. Rows of no id count as links but
    name no component. Labels and other columns are not read; an empty table gives no rows.
    """
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    infinite = F.lit(float("inf"))
    fine = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite)) \
        & F.exists("v", lambda x: x != 0)
    rows = stage(rows.withColumn("fine", F.coalesce(fine, F.lit(False))), "vectors")
    valid = rows.where("fine").groupBy("v").agg(F.count(F.lit(1)).alias("copies"))
    nodes = stage(valid.withColumns({"dim": F.size("v"), "place": F.xxhash64("v"),
                                     "node": F.monotonically_increasing_id()}), "vector-nodes")
    n, dim = nodes.agg(F.count(F.lit(1)), F.max("dim")).first()
    size = n * (dim or 1) * 8
    shards, blocks = max(LEAST_SHARDS, math.ceil(size / SHARD_BYTES)), max(LEAST_BLOCKS, math.ceil(size / BLOCK_BYTES))
    placed = nodes.withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    # a share of the nodes by hash first, about twice as many as are drawn, so that one task never sorts more
    chance = F.pmod(F.xxhash64("place"), F.lit(max(n, 1)))
    drawn = nodes.where(chance < 2 * AUDITED).orderBy(chance, "node").limit(AUDITED).select("dim", "node", "v").withColumn("shard", every)
    graphs = stage(_grouped(placed, ["dim", "shard"], shards).cogroup(_grouped(drawn, ["dim", "shard"], shards)).applyInPandas(
        _build, "dim int, shard int, width int, graph binary, nodes binary, raw binary, copies binary"), "graphs")
    queries = (nodes.withColumn("block", F.pmod(F.xxhash64("place", F.lit(1)), F.lit(blocks)).cast("int"))
               .select("dim", "block", "node", "v").withColumn("shard", every))
    spread = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dim", "shard", "block"]
    found = stage(_grouped(queries, key, shards * blocks).cogroup(_grouped(spread, key, shards * blocks)).applyInPandas(
        _query, "a long, b long, n long"), "found")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.select("a", "b"))
    named = (rows.join(nodes.select("v", "node", "copies"), "v", "left").join(counts, "node", "left")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = named.where("fine").groupBy("root").agg(F.min("vec_id").alias("least"))
    named = named.join(least, "root", "left").withColumn(
        "component_id", F.when(F.col("fine"), F.col("least")).otherwise(F.col("vec_id")))
    count = F.when(F.col("fine"), F.coalesce("n", F.lit(0)) + F.col("copies") - 1).otherwise(0)
    return named.select("vec_id", count.cast("long").alias("n_links"), "component_id",
                        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op10_near_duplicates(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
