"""Packing tokens into sequences: bounded-space online best fit, then a merge of leftovers."""
from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import documents, small_batches, stage

LENGTH = 1024
OPEN_WINDOWS = 64         # a partition keeps so many sequences open
MERGE_PIECES = 100_000    # pieces that one task of the merge handles
END = 0                   # id after each document
VOCABULARY = "byte_bpe_50k"
SPECIAL = {"<|endoftext|>": 50256}

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Ids:
    """Little-endian 32-bit ids of whole texts, one call of the library for each."""

    def __init__(self, ranks: str):
        lines = (line.split() for line in open(ranks, "rb"))
        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, special_tokens=SPECIAL,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in lines})

    def of(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


class Windows:
    """Open sequences found by their remaining room; never more than ``limit`` of them."""

    def __init__(self, limit: int, length: int):
        self.limit, self.length = limit, length
        self.by_room: list[list] = [[] for _ in range(length + 1)]
        self.mask = 0  # bit r is set while a window with room r is open
        self.count = 0

    def put(self, window: list, room: int) -> None:
        self.by_room[room].append(window)
        self.mask |= 1 << room
        self.count += 1

    def take(self, room: int) -> list:
        window = self.by_room[room].pop()
        if not self.by_room[room]:
            self.mask &= ~(1 << room)
        self.count -= 1
        return window

    def add(self, items: list, size: int) -> list | None:
        """Place items of ``size`` where least room remains; a window that is full, or the
        fullest one if a new one had no place, comes back."""
        out, fits = None, self.mask >> size << size
        if fits:
            room = (fits & -fits).bit_length() - 1
            window = self.take(room)
        else:
            if self.count >= self.limit:
                out = self.take((self.mask & -self.mask).bit_length() - 1)
            window, room = [], self.length
        window += items
        if room == size:
            return window  # only when it fitted, so nothing else was emitted
        self.put(window, room - size)
        return out

    def rest(self) -> Iterator[list]:
        while self.mask:
            yield self.take((self.mask & -self.mask).bit_length() - 1)




def _first(ranks: str, length: int, limit: int, keep_ids: bool):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, windows = Ids(ranks), Windows(limit, length)
        following = TaskContext.get().partitionId() << 32
        end = np.array([END], dtype="<u4").tobytes()
        columns = [c.split()[0] for c in PIECE.split(",")] + ["ids"] * keep_ids
        rows: list[tuple] = []

        def piece(key, ids, start, stop):
            part = ids[4 * start:4 * stop]
            head = (key, start, stop - start, zlib.crc32(part), len(ids) // 4)
            return head, part

        def table(rows):
            data = [(*r[0], *r[2:], *([r[1]] * keep_ids)) for r in rows]
            return pd.DataFrame(data, columns=columns).astype({"doc_id": "Int64", "sequence_id": "Int64", "offset": "Int64"})

        def emit(window, sequence):
            offset = 0
            for head, part in window:
                rows.append((head, part, sequence, None if sequence is None else offset))
                offset += head[2]

        for batch in batches:
            for key, text in zip(batch["doc_id"], batch["text"]):
                ids = encoder.of(text or "") + end
                total, start = len(ids) // 4, 0
                key = None if pd.isna(key) else int(key)
                while total - start >= length:
                    emit([piece(key, ids, start, start + length)], following)
                    following += 1
                    start += length
                if start < total:
                    done = windows.add([piece(key, ids, start, total)], total - start)
                    if done is not None:
                        emit(done, following)
                        following += 1
                if len(rows) >= 5_000:
                    yield table(rows)
                    rows = []
        for window in windows.rest():
            emit(window, None)
        if rows:
            yield table(rows)

    return pack


def _merge(length: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames:
            return
        left = pd.concat(frames, ignore_index=True)
        sizes = left["length"].to_numpy()
        windows, following = Windows(len(left) + 1, length), (1 << 62) + (TaskContext.get().partitionId() << 32)
        sequence = np.zeros(len(left), dtype=np.int64)
        offset = np.zeros(len(left), dtype=np.int64)
        done = (windows.add([row], int(sizes[row])) for row in np.argsort(-sizes, kind="stable"))
        full = [w for w in done if w is not None]
        for window in [*full, *windows.rest()]:
            at = 0
            for row in window:
                sequence[row], offset[row] = following, at
                at += sizes[row]
            following += 1
        left["sequence_id"], left["offset"] = sequence, offset
        yield left

    return pack


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
         open_windows: int = OPEN_WINDOWS, ranks: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces of documents with their place in sequences of at most ``length`` tokens.

    A document is its ids and one end id. Whole stretches of ``length`` ids fill sequences by
    themselves; what remains of a document goes to the open sequence of its partition where
    it fits best. If it fits in none and ``open_windows`` are open, the fullest is emitted.
    What is open at the end of a partition is merged by best fit, largest piece first, in as
    many tasks as its pieces need. A piece is (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset), with the ids as little-endian 32-bit words if ``keep_ids``. Texts
    are read and encoded once, in one pass without a shuffle; only leftovers move.

    A null text is empty and so one end id. Rows are packed as they come: equal rows or ids
    each get pieces of their own. Long texts need memory for their own ids only. An empty
    table gives no pieces; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ranks = ranks or public_tokenizers.path(f"{VOCABULARY}.tiktoken")
    schema = PIECE + ", ids binary" * keep_ids
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = stage(slim.mapInPandas(_first(ranks, length, open_windows, keep_ids), schema), "pieces")
    left = pieces.where("sequence_id IS NULL")
    tasks = max(1, math.ceil(left.count() / MERGE_PIECES))
    merged = left.coalesce(tasks) if tasks == 1 else left.repartition(tasks)
    return pieces.where("sequence_id IS NOT NULL").unionByName(merged.mapInPandas(_merge(length), schema))


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences of ``pack(..., keep_ids=True)``: ids in order, with the pieces' lengths."""
    row = F.struct("offset", "length", "ids")
    return (pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(row)).alias("p"))
            .select("sequence_id", F.transform("p", lambda p: p["length"]).alias("lengths"),
                    F.concat(F.lit(b""), F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))).alias("ids")))


def op4_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir))
