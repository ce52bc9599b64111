"""The corpus pipeline: five stages, each over all that the one before it kept."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import jaccard, language, mixing, packing, pii
from pagewright.llm.common import documents, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go."""
    return language.known_language(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one of smallest id stays."""
    return jaccard.distinct_documents(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no document goes."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences; each repetition is packed by itself."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("ngram_jaccard", ngram_jaccard), ("pii", personal_data),
          ("mixing", mix), ("packing", pack)]

# The trained stages cannot be said in SQL; tests hold the columns and rows of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
