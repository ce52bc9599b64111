"""Importance resampling toward a target distribution: features are counted once for each distinct line."""
from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.alnum import PLAIN, words
from pagewright.llm.common import documents, small_batches, stage, unstage
from pagewright.operators.numbering import number_rows

BUCKETS = 10_000
LEAST_WORDS = 20      # documents with fewer words are not drawn
PERCENT = 5           # of the others that many in a hundred are drawn
SEED = 42
HOT_LINES = 1_000     # lines that make up at least 1 / HOT_LINES of all; there are never more of them
TOGETHER = 512        # lines that are decoded at once

SEGMENT = "row long, doc_id long, across binary, line binary, times long"
LINE = "line binary, n long, n_features long, gaps binary"


def buckets(found: list[bytes]) -> np.ndarray:
    """The bucket of every run of one to three words; a longer run's crc goes on from a shorter one's."""
    spaced = [b" " + w for w in found]
    one = list(map(crc32, found))
    two = list(map(crc32, spaced[1:], one))
    three = list(map(crc32, spaced[2:], two))
    return np.array(one + two + three, np.uint32) % BUCKETS


def across_lines(lines: list[bytes]) -> list[int]:
    """The buckets of the runs that reach over a newline, from the first and last two words of lines."""
    found, x, y = [], None, None  # the two words before the line
    for line in lines:
        head = line.split(None, 2)
        if not head:
            continue
        a = head[0]
        if y is not None:
            found.append(crc32(y + b" " + a))
            if x is not None:
                found.append(crc32(x + b" " + y + b" " + a))
            if len(head) > 1:
                found.append(crc32(y + b" " + a + b" " + head[1]))
        if len(head) > 1:
            x, y = line.rsplit(None, 2)[-2:]
        else:
            x, y = y, a
    return [c % BUCKETS for c in found]


def pack(found: np.ndarray) -> bytes:
    """Buckets of a line as gaps between sorted ones, low bytes apart from high ones (mostly zeros)."""
    gaps = np.diff(np.sort(found), prepend=0).astype("<u2")
    return gaps.view(np.uint8).reshape(-1, 2).T.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(2, -1).T).view("<u2").ravel().cumsum(dtype=np.int64)


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        heads, rows, keys, times = [], [], [], []
        for text in batch["text"]:
            raw = (text or "").encode().split(b"\n")
            lines = [line.translate(PLAIN) for line in raw]
            heads.append((row, np.array(across_lines(lines), "<u2").tobytes()))
            seen = Counter(r for r, line in zip(raw, lines) if line and not line.isspace())
            rows += [row] * len(seen)
            keys += [hashlib.md5(r, usedforsecurity=False).digest() for r in seen]
            times += seen.values()
            row += 1
        own, across = zip(*heads) if heads else ((), ())
        yield pd.DataFrame({"row": own, "doc_id": batch["doc_id"].astype("Int64").array, "across": across, "line": None, "times": None})
        yield pd.DataFrame({"row": rows, "doc_id": pd.array([None] * len(rows), "Int64"), "across": None, "line": keys, "times": times})


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [buckets(words(line)) for line in batch["line"]]
        yield pd.DataFrame({"line": [hashlib.md5(line.encode(), usedforsecurity=False).digest() for line in batch["line"]],
                            "n": batch["n"], "n_features": [len(f) for f in found], "gaps": [pack(f) for f in found]})


def _bucket_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of a task, one row for each bucket; lines count as often as they occur."""
    sums = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for i in range(0, len(batch), TOGETHER):
            part = batch.iloc[i:i + TOGETHER]
            found = [unpack(gaps) for gaps in part["gaps"]] + [np.empty(0, np.int64)]
            often = np.repeat(part["n"].to_numpy(np.int64), [len(f) for f in found[:-1]])
            at, inverse = np.unique(np.concatenate(found), return_inverse=True)
            # sums of integers, exact below 2 ** 53
            sums[at] += np.bincount(inverse, often, len(at)).astype(np.int64)
    at = np.flatnonzero(sums)
    yield pd.DataFrame({"bucket": at, "s": sums[at]})


def _across_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        sums += np.bincount(np.frombuffer(b"".join(batch["across"]), "<u2"), minlength=BUCKETS)
    at = np.flatnonzero(sums)
    yield pd.DataFrame({"bucket": at, "s": sums[at]})


def segments(docs: DataFrame, doc_id: str | None, text: str) -> tuple[DataFrame, DataFrame]:
    """Two staged tables: per document one row with the runs across its lines and one for each of
    its lines; and the distinct lines with their occurrences and features."""
    ident = F.col(doc_id).cast("long") if doc_id else F.lit(None).cast("long")
    slim = docs.select(ident.alias("doc_id"), F.col(text).alias("text"))
    parts = stage(slim.mapInPandas(_segments, SEGMENT), "segments")
    distinct = (slim.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"))
                .groupBy("line").agg(F.count(F.lit(1)).alias("n")))
    return parts, stage(distinct.mapInPandas(_lines, LINE), "lines")


def bucket_counts(parts: DataFrame, lines: DataFrame) -> np.ndarray:
    """Occurrences of features by bucket: those of distinct lines times their occurrences, plus
    those across lines. At most ``BUCKETS`` rows reach the driver."""
    inside = lines.select("n", "gaps").mapInPandas(_bucket_sums, "bucket int, s long")
    over = parts.where("across IS NOT NULL").select("across").mapInPandas(_across_sums, "bucket int, s long")
    table = inside.unionByName(over).groupBy("bucket").agg(F.sum("s").alias("s")).toPandas()
    counts = np.zeros(BUCKETS, np.int64)
    counts[table["bucket"].to_numpy(np.int64)] = table["s"].to_numpy(np.int64)
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much likelier a bucket is in the target, smoothed by one each."""
    all_s, all_t = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_s + BUCKETS) / ((s + 1.0) * (all_t + BUCKETS))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _line_weights(gain: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["line", "n", "n_features"]].assign(weight=[int(gain[unpack(gaps)].sum()) for gaps in batch["gaps"]])

    return run


def _across_weights(gain: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.frombuffer(across, "<u2") for across in batch["across"]]
            yield batch[["row", "doc_id"]].assign(n_features=[len(f) for f in found], weight=[int(gain[f].sum()) for f in found])

    return run


def weigh(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """One row per document: row (a key of its own), doc_id, n_features and weight, the sum of
    the gains of its features. See ``resample``."""
    small_batches(docs.sparkSession)
    parts, lines = segments(docs, doc_id, text)
    like = segments(target, None, target_text)
    gain = gains(bucket_counts(parts, lines), bucket_counts(*like))
    unstage(*like)

    weights = stage(lines.select("line", "n", "n_features", "gaps").mapInPandas(
        _line_weights(gain), "line binary, n long, n_features long, weight long"), "line-weights")
    unstage(lines)
    # A line with at least 1 / HOT_LINES of all occurrences is met where documents lie; there
    # are at most HOT_LINES of them. All other lines are joined by key, and none of them is hot.
    often = (weights.agg(F.sum("n")).first()[0] or 0) / HOT_LINES
    hot = F.broadcast(weights.where((F.col("n") >= often)).drop("n"))
    of_docs = parts.where("line IS NOT NULL").select("row", "line", "times")
    met = of_docs.join(hot, "line").unionByName(
        of_docs.join(hot.select("line"), "line", "left_anti").join(weights.where(F.col("n") < often).drop("n"), "line"))
    inside = met.select("row", F.lit(None).cast("long").alias("doc_id"), (F.col("n_features") * F.col("times")).alias("n_features"),
                        (F.col("weight") * F.col("times")).alias("weight"))
    over = parts.where("across IS NOT NULL").select("row", "doc_id", "across").mapInPandas(
        _across_weights(gain), "row long, doc_id long, n_features long, weight long")
    weighed = stage(over.unionByName(inside).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_features").alias("n_features"), F.sum("weight").alias("weight")), "weighed")
    unstage(parts, weights)
    return weighed


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score and rank, null if it is not drawn.

    Features are all runs of one to three words, in hashed buckets. A bucket's gain is the
    logarithm of how much likelier it is in the target than among the documents; a document's
    weight sums the gains of its features. The score adds Gumbel noise that a hash of seed and
    id decides, so that the highest scores are a weighted draw without replacement that every
    rerun repeats.

    Newlines separate words, so a text is cut into lines there. Features of each distinct line
    are counted once, whole corpus over, and multiplied by its occurrences; runs across lines are
    added from the words at their ends. Documents meet the weights of their lines by a join on
    the line's hash (128 bits).

    A null or empty text has no features and weight 0; a null id hashes as an empty string and
    ranks after equal scores with an id. Repeated rows, and rows of one id, are documents of
    their own, ranked next to each other. Other columns are not read. An empty table gives no
    rows; an empty target makes all gains those of an even distribution.
    """
    weighed = weigh(docs, target, doc_id, text, target_text)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = weighed.withColumn("score", F.col("weight") + noise)
    # n words have 3n - 3 features, for n above 1
    fit = F.col("n_features") >= 3 * least_words - 3 if least_words > 1 else F.col("n_features") >= least_words
    drawn = percent * scored.where(fit).count() // 100
    ranked = number_rows(scored.where(fit), [], [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row"], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    rest = scored.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def op11_importance_resampling(spark, sf_dir):
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# crc32 by its table of 256 entries, from the polynomial
ORACLE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
w AS (SELECT side, r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
g AS (SELECT side, r, unnest(w) AS f FROM w
  UNION ALL SELECT side, r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
  UNION ALL SELECT side, r, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
k AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM g)),
h AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b FROM k, crc),
n AS (SELECT side, r, b, count(*) AS n FROM g JOIN h USING (f) GROUP BY ALL),
s AS (SELECT b, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM n GROUP BY 1),
al AS (SELECT sum(s) AS s, sum(t) AS t FROM s),
gain AS (SELECT b, floor(1000 * ln((s.t + 1)::DOUBLE * (al.s + 10000)::DOUBLE / ((s.s + 1)::DOUBLE * (al.t + 10000)::DOUBLE)))::BIGINT AS gain FROM s, al),
d AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM n JOIN gain USING (b) WHERE side = 0 GROUP BY 1),
e AS (SELECT w.r, doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(w) AS words,
    ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM w LEFT JOIN d ON d.r = w.r WHERE side = 0),
f AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT)::BIGINT AS score FROM e),
o AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (words >= 20) OVER () AS fit FROM f)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= 5 * fit // 100 THEN place END AS rank FROM o
"""
