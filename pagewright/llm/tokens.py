"""Token counts: batches balanced by bytes, long texts split at safe boundaries."""
from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import documents, small_batches

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SEGMENT = 16_384       # characters a segment has at least before it is cut
BATCH_BYTES = 1 << 20  # of text handed to the library at once

# One space between two characters that are none: no piece of the vocabulary reaches across,
# and the mark that the library puts before a text stands for the space.
SAFE = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str, least: int = SEGMENT) -> Iterator[str]:
    """The text in parts whose token counts add up to its own. A part without a safe
    boundary stays whole, however long."""
    start = 0
    while len(text) - start > least:
        cut = SAFE.search(text, start + least)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.end()
    yield text[start:]


def _counter(model: str):
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = sentencepiece.SentencePieceProcessor(model_file=model)
        for texts in batches:
            totals = [0] * len(texts)
            rows, parts, held = [], [], 0

            def flush():
                for row, ids in zip(rows, encoder.encode(parts, num_threads=1)):
                    totals[row] += len(ids)

            for row, text in enumerate(texts):
                for part in segments(text or ""):
                    rows.append(row)
                    parts.append(part)
                    held += 4 * len(part)
                    if held >= BATCH_BYTES:
                        flush()
                        rows, parts, held = [], [], 0
            flush()
            yield pd.Series(totals, dtype="int64")

    return F.pandas_udf(count, "long")


def with_token_counts(docs: DataFrame, text: str = "text", out: str = "n_tokens",
                      model: str | None = None) -> DataFrame:
    """Add the number of tokens of each text; nothing but lengths leaves the Python side.

    Texts are cut into segments at spaces where the count stays the same, and handed to the
    library in batches of about a megabyte. Null and empty texts have 0 tokens. ``out``
    replaces a column of that name; order, copies and other columns do not matter. No
    shuffle, so no key can be hot.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(out, _counter(model or public_tokenizers.path(MODEL))(F.col(text)))


def op7_token_counts(spark, sf_dir):
    counted = with_token_counts(documents(spark, sf_dir).select("doc_id", "text"))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                          "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
