"""Scores of a hashed maximum-entropy language model with a softmax factored into a tree of classes."""
from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import documents, small_batches, stage, unstage

END = b" "               # no word holds a blank
FREQUENT = 200_000       # words with counts that every worker holds, at most
LONGEST = 64             # bytes of such a word, at most
WIDTH = 16               # branches of a class: classes or words
LEAST_FEATURES = 1 << 12  # rows of the hashed weight table at least; else one for so many distinct words ...
ROW_WORDS = 4
ROW_TOKENS = 128         # ... or tokens
MOST_FEATURES = 1 << 20  # rows at most, 67 MB: the driver and every worker hold them
MOST_BUCKETS = 1 << 18   # leaves at most for the words outside the table
PART_TOKENS = 20_000_000  # tokens that one partition steps along, about
HASHED = 3               # features of a token: previous word, the one before (skip), both
ROUNDS = 2               # rounds of updates; each trains on its own share of the documents
RATE = 0.15
BATCH = 1 << 15          # tokens of one update
FLUSH = 300_000          # words that a worker counts before it hands them on
NEAR = 1 << 12           # rows that numpy works on at once: a few such arrays stay in the cache
ONES = np.ones(WIDTH, np.float32)
BLOCK = 256              # rows of the weight table in one row of an update


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, then the end."""
    return [*(text or "").encode().lower().split(), END]


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            found.update(tokens(text))
            if len(found) > FLUSH:
                yield pd.DataFrame({"word": list(found), "c": list(found.values())})
                found.clear()
    yield pd.DataFrame({"word": list(found), "c": list(found.values())})


def tree(masses: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, branch) of all leaves, then of all classes, and the logarithms of the shares of
    each class's branches. The lightest classes are joined first, so that common words have
    short paths; the last class is the root and its parent is -1."""
    n = len(masses)
    empty = max(WIDTH - n, 0) or -(n - 1) % (WIDTH - 1)
    order = np.argsort(masses, kind="stable")
    light = [1e-12] * empty + masses[order].tolist()
    classes = (len(light) - 1) // (WIDTH - 1)
    share, made = np.zeros((classes, WIDTH)), []
    above, place_of = np.zeros(len(light), np.int32), np.zeros(len(light), np.int8)  # of leaves, lightest first
    parent, branch = np.full(n + classes, -1, np.int32), np.zeros(n + classes, np.int8)
    i = j = 0
    for k in range(classes):
        for place in range(WIDTH):
            if j >= len(made) or (i < len(light) and light[i] <= made[j]):
                share[k, place], above[i], place_of[i] = light[i], k, place
                i += 1
            else:
                share[k, place], parent[n + j], branch[n + j] = made[j], k, place
                j += 1
        made.append(float(share[k].sum()))
    parent[order], branch[order] = above[empty:], place_of[empty:]
    return parent, branch, np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)


def _put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Rows written as single values: several times faster than ``table[at] = rows``."""
    whole = np.dtype((np.void, table.itemsize * table.shape[1]))
    table.view(whole).ravel()[at] = rows.view(whole).ravel()


def _take(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    whole = np.dtype((np.void, table.itemsize * table.shape[1]))
    return table.view(whole).ravel().take(at).view(table.dtype).reshape(-1, table.shape[1])


class Model:
    """Biases start at the logarithms of the counts, weights at 0: a unigram model at first.

    A leaf of the tree is a word of the table or a bucket of other words; ``buckets`` has the
    counts of these, half a count for each word and for one unseen word included."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, buckets: np.ndarray):
        self.total, self.distinct, self.buckets = total, distinct, buckets
        self.counts = dict(zip(words, counts))
        self.ids = {w: i for i, w in enumerate(words)}
        self.parent, self.branch, self.bias = tree(np.concatenate([np.array(counts, float) + 0.5, buckets]))
        self.leaves = len(words) + len(buckets)
        rows = max(LEAST_FEATURES, distinct // ROW_WORDS, total // ROW_TOKENS)
        self.rows = min(1 << (rows - 1).bit_length(), MOST_FEATURES)
        self.weight = np.zeros((self.rows, WIDTH), np.float32)

    def __getstate__(self) -> dict:
        """What travels to workers and lies on each of their disks: arrays packed, of the weights only
        rows that moved, and counts of buckets as whole numbers of halves."""
        at = np.flatnonzero(self.weight.any(axis=1))
        half = self.weight[at].astype(np.float16)
        exact = np.array_equal(half, self.weight[at])
        packed = {"parent": self.parent, "branch": self.branch, "bias": self.bias, "at": at.astype(np.int32),
                  "buckets": (2 * self.buckets).astype(np.int64) if (2 * self.buckets % 1 == 0).all() else self.buckets,
                  "moved": half if exact else self.weight[at]}
        rest = {k: v for k, v in self.__dict__.items() if k not in (*packed, "weight")}
        return rest | {"packed": {k: (zlib.compress(v.tobytes(), 1), v.dtype.str, v.shape) for k, v in packed.items()}}

    def __setstate__(self, state: dict) -> None:
        arrays = {k: np.frombuffer(zlib.decompress(v), dtype).reshape(shape) for k, (v, dtype, shape) in state.pop("packed").items()}
        at, moved, buckets = arrays.pop("at"), arrays.pop("moved"), arrays.pop("buckets")
        self.__dict__ = state | arrays
        self.buckets = buckets / 2 if buckets.dtype == np.int64 else buckets
        self.weight = np.zeros((self.rows, WIDTH), np.float32)
        self.weight[at] = moved

    def twin(self) -> Model:
        """A model with weights of its own; the rest is shared."""
        other = object.__new__(Model)
        other.__dict__ = self.__dict__ | {"weight": self.weight.copy()}
        return other

    def encode(self, found: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(leaves, features) of all tokens; a word outside the table has the leaf of its bucket."""
        ids, known, first, buckets = [], self.ids.get, len(self.ids), len(self.buckets)
        for words in found:
            ids.append(-1)
            ids.append(-1)
            ids += [i if (i := known(w)) is not None else first + zlib.crc32(w) % buckets for w in words]
        ids = np.array(ids, np.int64)
        starts = np.cumsum([0, *[len(w) + 2 for w in found]])[:-1]
        real = np.ones(len(ids), bool)
        real[starts] = real[starts + 1] = False
        at = np.flatnonzero(real)
        one, two = ids[at - 1].astype(np.uint64), ids[at - 2].astype(np.uint64)
        mixed = np.stack([one * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1),
                          two * np.uint64(0xD1342543DE82EF95) + np.uint64(2),
                          (one * np.uint64(0x9E3779B97F4A7C15) ^ two * np.uint64(0xBF58476D1CE4E5B9)) * np.uint64(0x94D049BB133111EB)], 1)
        return ids[at], mixed ^ (mixed >> np.uint64(29))

    def path(self, ids: np.ndarray, x: np.ndarray):
        """For every class on the way from the root to each token: the token, the class, the branch
        taken, rows of the weight table."""
        tokens, nodes, branches = [], [], []
        token, node = np.arange(len(ids)), ids
        while len(token):
            up = self.parent[node]
            on = up >= 0
            token, taken, up = token[on], self.branch[node[on]], up[on]
            tokens.append(token)
            nodes.append(up)
            branches.append(taken)
            node = up.astype(np.int64) + self.leaves
        token, node, taken = np.concatenate(tokens), np.concatenate(nodes), np.concatenate(branches)
        mixed = x[token]
        mixed += node.astype(np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93)
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed >>= np.uint64(64 - self.rows.bit_length() + 1)
        return token, node, taken, mixed.view(np.int64)

    def odds(self, node: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Odds of the branches of some classes, and their sums."""
        odds = self.bias.take(node, 0)
        for j in range(HASHED):
            odds += self.weight.take(rows[:, j], 0)
        with np.errstate(over="ignore"):
            found = np.exp(odds)
            sums = found @ ONES
        if not (sums.min(initial=1) > 1e-30 and sums.max(initial=1) < 1e30):  # near the ends of what floats hold
            odds -= odds.max(axis=1, keepdims=True)
            found = np.exp(odds)
            sums = found @ ONES
        return found, sums

    def forward(self, ids: np.ndarray, x: np.ndarray):
        """As ``path``, with probabilities of the branches in place of the class."""
        token, node, taken, rows = self.path(ids, x)
        p = np.empty((len(node), WIDTH), np.float32)
        for i in range(0, len(node), NEAR):
            odds, sums = self.odds(node[i:i + NEAR], rows[i:i + NEAR])
            np.divide(odds, sums[:, None], out=p[i:i + NEAR])
        return token, taken, rows, p

    def log10(self, ids: np.ndarray, x: np.ndarray) -> np.ndarray:
        """log10 P(leaf | context) of each token."""
        token, node, taken, rows = self.path(ids, x)
        p = np.empty(len(node))
        for i in range(0, len(node), NEAR):
            odds, sums = self.odds(node[i:i + NEAR], rows[i:i + NEAR])
            p[i:i + NEAR] = odds[np.arange(len(sums)), taken[i:i + NEAR]] / sums
        return np.bincount(token, np.log10(np.maximum(p, 1e-30)), len(ids))

    def update(self, ids: np.ndarray, x: np.ndarray, past: np.ndarray, touched: np.ndarray) -> None:
        """One step along the gradient of the log likelihood, scaled by past gradients, in the
        rows that the tokens touch."""
        _, taken, rows, p = self.forward(ids, x)
        p[np.arange(len(taken)), taken] -= 1
        # equal rows side by side, each with the place of its gradient
        bits = rows.size.bit_length()
        key = np.sort(rows.ravel() << bits | np.arange(rows.size))
        row, place = key >> bits, (key & ((1 << bits) - 1)) // HASHED
        start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        at, n = row[start], np.diff(np.append(start, len(row)))
        touched[at] += n
        # most rows have one gradient; those of others are added in pairs until there is one
        while len(at):
            one = n == 1
            self.move(at[one], p, start[one] if place is None else place[start[one]], past)
            at, start, n = at[~one], start[~one], n[~one]
            half = (n + 1) // 2
            end = np.cumsum(half)
            left = np.repeat(start - 2 * (end - half), half) + 2 * np.arange(end[-1] if len(end) else 0)
            lone = (end - 1)[n % 2 == 1]
            right = left + 1
            right[lone] = left[lone]
            if place is not None:
                left, right = place[left], place[right]
            added = _take(p, right)
            added[lone] = 0
            added += _take(p, left)
            p, place, start, n = added, None, end - half, half

    def move(self, at: np.ndarray, gradients: np.ndarray, place: np.ndarray, past: np.ndarray) -> None:
        """The step of distinct rows, a few at a time: what is worked on stays near the processor."""
        for i in range(0, len(at), NEAR):
            here = at[i:i + NEAR]
            step, seen = _take(gradients, place[i:i + NEAR]), _take(past, here)
            seen += step * step
            _put(past, here, seen)
            seen += 1
            np.sqrt(seen, out=seen)
            step *= RATE
            step /= seen
            _put(self.weight, here, np.subtract(_take(self.weight, here), step, out=step))


def _train(shared: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, start = shared.value.twin(), shared.value.weight  # a worker's next task gets the same value
        past = np.zeros_like(start)
        touched = np.zeros(model.rows, np.float32)
        held, size = [], 0

        def step():
            ids, x = model.encode(held)
            for i in range(0, len(ids), BATCH):
                model.update(ids[i:i + BATCH], x[i:i + BATCH], past, touched)

        for batch in batches:
            for text in batch["text"]:
                held.append(tokens(text))
                size += len(held[-1])
                if size >= BATCH:
                    step()
                    held, size = [], 0
        if held:
            step()
        part = TaskContext.get().partitionId()
        for i in range(0, model.rows, BLOCK * 256):
            out = []
            for j in range(i, min(i + BLOCK * 256, model.rows), BLOCK):
                at = np.flatnonzero(touched[j:j + BLOCK])
                if len(at):
                    out.append((j // BLOCK, part, at.astype("u1").tobytes(), touched[j + at].astype("<f4").tobytes(),
                                (model.weight[j + at] - start[j + at]).astype("<f2").tobytes()))
            if out:
                yield pd.DataFrame(out, columns=["block", "part", "at", "touched", "moved"])

    return run


def _mean(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Touches and the mean movement of each row of a block, weighted by touches."""
    touched, moved = np.zeros(BLOCK), np.zeros((BLOCK, WIDTH))
    for at, n, steps in zip(group["at"], group["touched"], group["moved"]):
        at, n = np.frombuffer(at, "u1"), np.frombuffer(n, "<f4").astype(float)
        touched[at] += n
        moved[at] += np.frombuffer(steps, "<f2").reshape(-1, WIDTH) * n[:, None]
    return touched, moved / np.maximum(touched, 1)[:, None]


def _add(group: pd.DataFrame) -> pd.DataFrame:
    touched, moved = _mean(group)
    at = np.flatnonzero(touched)
    return pd.DataFrame({"block": group["block"].iloc[:1], "part": group["part"].iloc[:1] // 256,
                         "at": [at.astype("u1").tobytes()], "touched": [touched[at].astype("<f4").tobytes()],
                         "moved": [moved[at].astype("<f2").tobytes()]})


UPDATE = "block int, part int, at binary, touched binary, moved binary"


def _added(updates: DataFrame) -> DataFrame:
    """The updates of 256 partitions added up; they are shuffled as they come and not written before."""
    return stage(updates.groupBy("block", F.floor(F.col("part") / 256).alias("g")).applyInPandas(_add, UPDATE), "updates")


def train(model: Model, docs: DataFrame, rounds: int = ROUNDS) -> Model:
    """Rounds of distributed updates: every partition steps along its own documents from the
    same model; the steps of each row are averaged, weighted by how often documents touch it, 256
    partitions at a time."""
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, model.total // PART_TOKENS)
    for turn in range(rounds):
        share = docs.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn) if rounds > 1 else docs
        shared = docs.sparkSession.sparkContext.broadcast(model)
        sums = _added(share.select("text").coalesce(parts).mapInPandas(_train(shared), UPDATE))
        shared.destroy()  # it lies on every executor's disk
        while (sums.agg(F.max("part")).first()[0] or 0) > 0:
            each, sums = sums, _added(sums)
            unstage(each)
        # rows / BLOCK rows, the size of the model
        for row in sums.toLocalIterator():
            at = np.frombuffer(row["at"], "u1").astype(np.int64) + row["block"] * BLOCK
            model.weight[at] += np.frombuffer(row["moved"], "<f2").reshape(-1, WIDTH).astype(np.float32)
        unstage(sums)
    return model


def _score(shared: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        z = math.log10(model.total + 0.5 * (model.distinct + 1))
        bucket_logs = np.log10(model.buckets)
        row = TaskContext.get().partitionId() << 36
        logs = np.array([math.log10(c + 0.5) for c in model.counts.values()])
        for batch in batches:
            found = [tokens(text) for text in batch["text"]]
            ids, x = model.encode(found)
            sizes = np.array([len(f) for f in found])
            owner = np.repeat(np.arange(len(found)), sizes)
            score = np.zeros(len(found))
            for i in range(0, len(ids), BATCH):
                part = slice(i, i + BATCH)
                score += np.bincount(owner[part], model.log10(ids[part], x[part]), len(found))
            inside = ids < len(model.ids)
            known = np.bincount(owner[inside], minlength=len(found))
            held, ends = logs[ids[inside]].tolist(), np.cumsum(known).tolist()
            base = [math.fsum(held[end - n:end]) - size * z for n, end, size in zip(known.tolist(), ends, sizes.tolist())]
            words, rare = list(chain.from_iterable(found)), np.flatnonzero(~inside).tolist()
            rest = [(row + i, w, n) for (i, w), n in Counter(zip(owner[~inside].tolist(), [words[j] for j in rare])).items()]
            outside = ~inside  # in a bucket, by counts: the rest is added by the join
            halves = np.bincount(owner[outside], bucket_logs[ids[outside] - len(model.ids)], len(found))
            yield pd.DataFrame({"row": row + np.arange(len(found)), "doc_id": batch["doc_id"].astype("Int64"),
                                "held_out": batch["held_out"], "n_tokens": sizes, "n_known": known, "base": base,
                                "score": score - halves, "word": None, "tf": None})
            for i in range(0, len(rest), 20_000):
                keys, words, n = zip(*rest[i:i + 20_000])
                yield pd.DataFrame({"row": keys, "doc_id": pd.array([None] * len(keys), "Int64"), "held_out": None,
                                    "n_tokens": None, "n_known": None, "base": None, "score": None, "word": words, "tf": n})
            row += len(found)

    return run


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (unigrams with half a count added) and score (the model), both log10 of the whole text.

    The model learns from documents whose crc32(id) mod 5 is not 1. All counted words are leaves
    of a tree of classes with 16 branches each; the branch taken in every class on the way to a
    token follows a softmax over hashed features: the previous word, the one before it, and
    both. Words that do not travel to workers are dealt by hash to at least as many buckets as
    there are of them, ``MOST_BUCKETS`` at most, each a leaf; those that meet in one share it by
    smoothed counts, an unseen word having half a count. Rows of the weight table grow with words
    and tokens up to ``MOST_FEATURES``, so that the model's memory is bounded. All training
    documents are counted and trained on, all documents scored.

    Counts of at most ``FREQUENT`` words, all of a count that few enough words reach, travel to
    workers; other words are joined with the table of counts. A null text is empty and has the
    end alone; a document without an id is trained on. Rows are told apart by place, so equal
    ids or rows do not matter, nor do other columns; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    remainder = F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5))
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), (remainder == 1).alias("held_out"))
    learn = slim.where(~F.col("held_out"))
    partial = learn.select("text").mapInPandas(_counts, "word binary, c long")
    counts = stage(partial.groupBy("word").agg(F.sum("c").alias("c")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()

    # the lowest count, in steps of an eighth of a power of two, that few enough words reach
    step = F.floor(F.log2("c") * 8).cast("int")
    levels = sorted(counts.where(F.octet_length("word") <= LONGEST).groupBy(step.alias("s")).count().collect(), reverse=True)
    room, least = FREQUENT, 10 ** 6
    for s, n in levels:
        if n > room:
            break
        room, least = room - n, s
    top = counts.where((F.octet_length("word") <= LONGEST) & (step >= least)).toPandas()
    top["word"] = top["word"].map(bytes)
    top = top.sort_values(["c", "word"], ascending=[False, True])
    outside = counts.where((F.octet_length("word") > LONGEST) | (step < least))
    buckets = np.full(min(1 << max(distinct - len(top) - 1, 0).bit_length(), MOST_BUCKETS), 0.5)
    # a row for each bucket
    other = outside.groupBy(F.pmod(F.crc32("word"), F.lit(len(buckets))).alias("b")).agg(F.sum(F.col("c") + 0.5).alias("m")).toPandas()
    buckets[other["b"].to_numpy(np.int64)] += other["m"].to_numpy(float)
    model = Model(top["word"].tolist(), top["c"].tolist(), total, distinct, buckets)
    if total:
        model = train(model, learn)

    schema = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
              "word binary, tf long")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = stage(slim.mapInPandas(_score(shared), schema), "scores")
    shared.destroy()
    rare = out.where("word IS NOT NULL").select("row", "word", "tf").join(counts, "word", "left")
    rare = rare.withColumn("c", F.coalesce("c", F.lit(0))).groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.col("c") + 0.5)).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("seen"))
    none = lambda c: F.coalesce(c, F.lit(0))
    return out.where("word IS NULL").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + none("seen")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + none("more")).alias("base_score"),
        (F.col("score") + none("more")).alias("score"))


def op5_lm_scoring(spark, sf_dir):
    return score(documents(spark, sf_dir))
