"""Vector code compression: product codebooks in integers, assigned with fixed pivots (LAESA)."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import stage, unstage
from pagewright.operators.numbering import same_keys

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
PIVOTS = 4
BOUND = 1 << 29       # integers are held within it, so that distances and sums fit 64 bits
SMALL = 10_000        # labels that are sent to every task; more are joined by shuffle


def choose_pivots(entries: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Entries of a part's first codebook that lie far apart: each one farthest from those before."""
    chosen = [0]
    apart = ((entries - entries[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(entries)):
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((entries - entries[chosen[-1]]) ** 2).sum(axis=1))
    return entries[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, rounded to single precision."""
    return np.sqrt(((x[:, None, :] - pivots[None]) ** 2).sum(axis=2)).astype(np.float32)


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(entry, squared distance) of every row, ties to the lower entry, and how many distances
    were evaluated.

    By the triangle inequality a row is no nearer to an entry than their distances to a pivot
    differ. Entries are evaluated, in integers, in order of that bound, until it exceeds the best
    distance found; the bounds are lowered by more than what rounding can add.
    """
    of_entries = distances(entries, pivots).astype(np.float64)
    bound = np.zeros((len(x), len(entries)))
    for p in range(len(pivots)):
        own = to_pivots[:, p].astype(np.float64)[:, None]
        np.maximum(bound, np.abs(own - of_entries[:, p]) - (own + of_entries[:, p]) * 1e-6, out=bound)
    np.square(bound, out=bound)
    best, at = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(entries))
    rows, evaluated = np.arange(len(x)), 0
    while len(rows):
        entry = bound.argmin(axis=1)
        on = bound[np.arange(len(rows)), entry] <= best[rows]
        rows, bound, entry = rows[on], bound[on], entry[on]
        apart = ((x[rows] - entries[entry]) ** 2).sum(axis=1)
        evaluated += len(rows)
        better = (apart < best[rows]) | ((apart == best[rows]) & (entry < at[rows]))
        best[rows[better]], at[rows[better]] = apart[better], entry[better]
        bound[np.arange(len(rows)), entry] = np.inf
    return at, best, evaluated


def integers(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    return np.clip(np.floor(x * SCALE), -BOUND, BOUND).astype(np.int64)


def _keep(pivots: list[np.ndarray]):
    """Integer parts of the vectors and their distances to the pivots, computed this once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = integers(batch["vector"])
                far = np.concatenate([distances(p, pivots[k]) for k, p in enumerate(np.split(x, len(pivots), axis=1))], axis=1)
                yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "x": [r.tobytes() for r in x.astype("<i4")],
                                    "far": [r.tobytes() for r in far.astype("<f4")]})

    return run


def assigned(batch: pd.DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(parts, entries, squared distances) of a batch for each part in turn."""
    x = np.frombuffer(b"".join(batch["x"]), "<i4").reshape(len(batch), -1).astype(np.int64)
    far = np.frombuffer(b"".join(batch["far"]), "<f4").reshape(len(batch), len(books), -1)
    for k, part in enumerate(np.split(x, len(books), axis=1)):
        at, apart, _ = nearest(part, far[:, k], books[k], pivots[k])
        yield part, at, apart


def _sums(books: list[np.ndarray], pivots: list[np.ndarray]):
    """A task's sums of the parts of each entry; as many rows as the codebooks have components."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros(book.shape, np.int64) for book in books]
        for batch in batches:
            if len(batch):
                for k, (part, at, _) in enumerate(assigned(batch, books, pivots)):
                    n[k] += np.bincount(at, minlength=len(books[k]))
                    np.add.at(sums[k], at, part)
        for k, (count, total) in enumerate(zip(n, sums)):
            entry, place = np.divmod(np.arange(total.size), total.shape[1])
            yield pd.DataFrame({"part": k, "entry": entry, "place": place, "n": count[entry], "s": total.ravel()})

    return run


def _codes(books: list[np.ndarray], pivots: list[np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = [(at, apart) for _, at, apart in assigned(batch, books, pivots)]
                codes = np.stack([at for at, _ in found], axis=1).astype(np.uint8)
                yield batch[["vec_id", "label"]].assign(code=[row.tobytes().hex() for row in codes], error=sum(apart for _, apart in found))

    return run


def compress(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS) -> DataFrame:
    """One row per kept vector: vec_id, code (two hexadecimal digits a part), error (squared
    distances to its entries), label_error (errors of its label) and codebooks_sha256.

    Components become integers, vectors ``parts`` equal parts, each with a codebook that starts
    as the parts of the smallest ids. A round assigns every part to the nearest entry and moves
    entries to the floored mean of theirs; all vectors take part. Distances of parts to the
    fixed pivots are computed and stored once; later rounds use them as lower bounds.

    Vectors that are null or hold a null or a component that is not finite are dropped, as are
    those of another length than the vector of the smallest id, which must be a multiple of
    ``parts``. Integers are held within 2 ** 29 (components within about two million), so that
    errors fit. Null ids come last among the smallest, equal ids in order of their vectors;
    repeated rows count each. Null labels are one label; without such a column, all are. Other
    columns are not read; an empty table, or one without a kept vector, gives no rows. Driver and
    tasks hold the codebooks alone; labels are aggregated before they are joined.
    """
    spark = table.sparkSession
    named = table.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"),
                         (F.col(label) if label in table.columns else F.lit(None).cast("int")).alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = named.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    length = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector")).first()
    kinds = dict(named.dtypes)
    schema = f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string"
    if length is None:
        return spark.createDataFrame([], schema)
    if length[0] % parts:
        raise ValueError(f"vectors of {length[0]} components cannot be cut into {parts} equal parts")
    kept = kept.where(F.size("vector") == length[0])
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toPandas()
    books = np.split(integers(first["vector"]), parts, axis=1)
    fixed = [choose_pivots(book, pivots) for book in books]

    stored = stage(kept.mapInPandas(_keep(fixed), f"vec_id {kinds['vec_id']}, label {kinds['label']}, x binary, far binary"), "parts")
    for _ in range(rounds):
        moved = (stored.select("x", "far").mapInPandas(_sums(books, fixed), "part int, entry int, place int, n long, s long")
                 .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).where("n > 0").toPandas())
        books = [book.copy() for book in books]
        for r in moved.itertuples():
            books[r.part][r.entry, r.place] = r.s // r.n
    digest = hashlib.sha256(",".join(str(c) for book in books for c in book.ravel().tolist()).encode()).hexdigest()

    coded = stage(stored.mapInPandas(_codes(books, fixed), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "codes")
    unstage(stored)
    by_label = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    if by_label.count() <= SMALL:
        by_label = F.broadcast(by_label)
    return same_keys(coded, by_label, ["label"]).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark, sf_dir):
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle(rounds: int = ROUNDS) -> str:
    turns = ""
    for i in range(rounds + 1):
        turns += f""",
m{i} AS (SELECT p.r, p.k, any_value(v) AS v, min(((v[1] - e[1]) ** 2 + (v[2] - e[2]) ** 2 + (v[3] - e[3]) ** 2 + (v[4] - e[4]) ** 2)::BIGINT * 64 + j) AS m
  FROM p JOIN c{i} AS c USING (k) GROUP BY 1, 2),
a{i} AS (SELECT r, k, v, m % 64 AS j, m // 64 AS error FROM m{i})"""
        if i < rounds:
            mean = ", ".join(f"floor(sum(v[{n}])::DOUBLE / count(*))::BIGINT" for n in range(1, 5))
            turns += f""",
s{i} AS (SELECT k, j, [{mean}] AS e FROM a{i} GROUP BY 1, 2),
c{i + 1} AS (SELECT k, j, coalesce(s.e, c.e) AS e FROM c{i} AS c LEFT JOIN s{i} AS s USING (k, j))"""
    return f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, unnest(range(16)) AS k, unnest(list_transform(range(16), lambda i: x[4 * i + 1:4 * i + 4])) AS v FROM v),
c0 AS (SELECT k, r AS j, v AS e FROM p WHERE r < 64){turns},
h AS (SELECT sha256(string_agg(list_aggregate(e, 'string_agg', ','), ',' ORDER BY k, j)) AS h FROM c{rounds}),
f AS (SELECT r, string_agg(printf('%02x', j), '' ORDER BY k) AS code, sum(error)::BIGINT AS error FROM a{rounds} GROUP BY 1)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM f JOIN v USING (r), h
"""


ORACLE = _oracle()
