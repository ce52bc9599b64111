"""Benchmark decontamination by winnowing: fingerprints are joined, then hits are extended to windows."""
from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.alnum import words
from pagewright.llm.common import documents, small_batches, stage, unstage

WINDOW = 10               # words of a window; a shared span of so many is always found
GRAM = 5                  # words of a hashed run
SLIDE = WINDOW - GRAM + 1  # runs of a window: the smallest hash of every so many neighbours is kept
FILTER_BITS = 1 << 22     # bounds what travels to workers: fingerprints of the benchmark by counter
SMALL = 50_000            # windows of a benchmark that is sent to every task; a larger one is joined by shuffle
CACHED_WORDS = 500_000    # a worker forgets its words beyond that

PRINT = "row long, doc_id long, n_words long, fp long, start long, size int, run string"
ITEM = "item string, fp long, size int, span string"


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def run_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words, from the hashes of the words."""
    n = len(h) - size + 1
    acc = np.full(max(n, 0), size, np.uint64)
    for j in range(size):
        acc = (acc ^ h[j:j + len(acc)]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return acc


def smallest(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the smallest run of every ``SLIDE`` neighbours, the last of equal ones."""
    n = len(grams) - SLIDE + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    low, at = grams[:n].copy(), np.arange(n)
    for j in range(1, SLIDE):
        less = grams[j:j + n] <= low
        low[less] = grams[j:j + n][less]
        at[less] = np.flatnonzero(less) + j
    return low, at


def _items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows of items with their fingerprint; that of a short item is its whole run's hash."""
    hashes = WordHashes()
    for batch in batches:
        out = []
        for item, text in zip(batch["item"], batch["text"]):
            found = words(text)
            h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
            size = min(len(found), WINDOW)
            fps = smallest(run_hashes(h, GRAM))[0] if size == WINDOW else run_hashes(h, size) if size else h
            out += [(item, int(fp), size, b" ".join(found[i:i + size]).decode()) for i, fp in enumerate(fps.view(np.int64))]
        yield pd.DataFrame(out, columns=["item", "fp", "size", "span"])


def _prints(bits: np.ndarray, short: list[int]):
    """Per document a row of its own, then its fingerprints that the benchmark may have, each
    with the words of all windows in which it is the smallest."""
    def may_have(fp: np.ndarray) -> np.ndarray:
        at = (fp % np.uint64(FILTER_BITS)).astype(np.int64)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, row = WordHashes(), TaskContext.get().partitionId() << 36
        for batch in batches:
            found = [words(text) for text in batch["text"]]
            sizes = np.array([len(f) for f in found], np.int64)
            flat = list(chain.from_iterable(found))
            first = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(found)), sizes)
            h = np.fromiter(map(hashes.__getitem__, flat), np.uint64, len(flat))
            out = []

            def give(starts: np.ndarray, ends: np.ndarray, fps: np.ndarray, size: int) -> None:
                for i, end, fp in zip(starts.tolist(), ends.tolist(), fps.view(np.int64).tolist()):
                    doc = owner[i]
                    out.append((row + doc, fp, i - first[doc], size, b" ".join(flat[i:end]).decode()))

            low, at = smallest(run_hashes(h, GRAM))
            if len(low):
                whole = owner[:len(low)] == owner[WINDOW - 1:]
                new = np.ones(len(low), bool)
                new[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1])
                starts = np.flatnonzero(new)
                ends = np.append(starts[1:], len(low)) + WINDOW - 1
                hit = whole[starts] & may_have(low[starts])
                give(starts[hit], ends[hit], low[starts[hit]], WINDOW)
            for size in short:
                fps = run_hashes(h, size)
                hit = np.flatnonzero((owner[:len(fps)] == owner[size - 1:]) & may_have(fps)) if len(fps) else np.empty(0, np.int64)
                give(hit, hit + size, fps[hit], size)
            yield pd.DataFrame({"row": row + np.arange(len(found)), "doc_id": batch["doc_id"].astype("Int64").array, "n_words": sizes,
                                "fp": None, "start": None, "size": None, "run": None})
            if out:
                rows, fps, starts, lengths, runs = zip(*out)
                yield pd.DataFrame({"row": rows, "doc_id": pd.array([None] * len(rows), "Int64"), "n_words": None, "fp": fps,
                                    "start": starts, "size": lengths, "run": runs})
            row += len(found)

    return run


def hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three staged tables: documents (row, doc_id, n_words), occurrences of windows (row, start,
    size, span) and windows of items (item, fp, size, span)."""
    small_batches(docs.sparkSession)
    items = stage(benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
                  .mapInPandas(_items, ITEM), "items")
    # at most FILTER_BITS counters and WINDOW lengths reach the driver
    used = items.select(F.pmod("fp", F.lit(FILTER_BITS)).alias("b")).distinct().toPandas()["b"].to_numpy(np.int64)
    bits = np.zeros(FILTER_BITS, np.uint8)
    bits[used] = 1
    bits = np.packbits(bits, bitorder="little")
    short = sorted(r[0] for r in items.select("size").distinct().collect() if r[0] < WINDOW)

    prints = stage(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
                   .mapInPandas(_prints(bits, short), PRINT), "prints")
    windows = stage(items.select("fp", "size", "span").distinct(), "windows")
    small = windows.count() <= SMALL
    known = windows.select("fp", "size").distinct()
    spans = windows.select("size", "span").distinct()
    if small:
        known, spans = F.broadcast(known), F.broadcast(spans)

    both = prints.where("fp IS NOT NULL").join(known, ["fp", "size"], "left_semi")
    parts = F.split("run", " ")
    each = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("size")),
                       lambda i: F.struct((F.col("start") + i).alias("start"),
                                          F.concat_ws(" ", F.slice("w", i + 1, F.col("size"))).alias("span")))
    extended = (both.select("row", "start", "size", parts.alias("w")).select("row", "size", F.explode(each).alias("e"))
                .select("row", "size", "e.start", "e.span"))
    found = stage(extended.join(spans, ["size", "span"]).select("row", "start", "size", "span"), "hits")
    rows = stage(prints.where("fp IS NULL").select("row", "doc_id", "n_words"), "hit-rows")
    unstage(prints, windows)
    return rows, found, items


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside an occurring window of the
    benchmark), n_items and items_sha256 (the items these windows belong to), contaminated.

    A window is ``WINDOW`` consecutive words of an item, or the whole of a shorter one. Of every
    ``SLIDE`` neighbouring runs of ``GRAM`` words the smallest hash is a fingerprint, so a document
    and an item that share a window share its fingerprint. Fingerprints of documents that pass a
    bit filter of the benchmark's are joined with these; each hit is extended to the windows
    around it, which are compared word by word. Runs of short items are looked up whole.

    A null text has no words. An item without words, or null, occurs nowhere; one without an id
    makes hits but is not listed; items of one id are one item. Rows are told apart by place, so
    repeated rows and ids do not matter, nor do other columns. Empty tables give no rows or hits.
    Only filtered fingerprints are shuffled; a benchmark of many windows is joined by shuffle too.
    """
    rows, found, items = hits(docs, benchmark, doc_id, text, item_id, item_text)
    none = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def cover(a, x):
        end = x["start"] + x["size"]
        return F.struct(F.greatest(a["end"], end).alias("end"),
                        (a["n"] + F.greatest(end - F.greatest(a["end"], x["start"]), F.lit(0))).alias("n"))

    # the windows of one document, by start
    covered = found.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("at"))
    covered = covered.select("row", F.aggregate("at", none, cover, lambda a: a["n"]).alias("n_hit"))
    owners = items.where("item IS NOT NULL").select("span", "item").distinct()
    if owners.count() <= SMALL:
        owners = F.broadcast(owners)
    listed = (found.select("row", "span").distinct().join(owners, "span").groupBy("row")
              .agg(F.array_sort(F.collect_set("item")).alias("items"))
              .select("row", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("listed")))
    zero = F.lit(0).cast("long")
    return (rows.join(covered.join(listed, "row", "left"), "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("listed", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", zero) > 0).alias("contaminated")))


def op13_decontamination(spark, sf_dir):
    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
    unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: list_aggregate(w[i:i + 9], 'string_agg', ' '))) AS s FROM b WHERE len(w) > 0),
x AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n),
h AS (SELECT r, i, x.n, item_id FROM (SELECT r, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS s FROM x) AS x JOIN k ON k.s = x.s AND k.n = x.n),
p AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY 1),
t AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""
