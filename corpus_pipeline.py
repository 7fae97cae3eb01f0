"""A training-data pipeline of five stages over ``documents``; each is written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folio.llm import bpe, decontam, exact_dedup, langid, near_dedup
from folio.llm.common import bounded_batches, stored, table
from folio.llm.queries import vocabulary

NEAR_PER_CENT = 80  # five-word shingles, similarity of 0.8 or more


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model does not reject."""
    bounded_batches(spark)
    return langid.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents, the one with the least id."""
    return near_dedup.dedup(docs, threshold=NEAR_PER_CENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of what is left."""
    return bpe.round_trip(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

# No SQL: two stages are a trained model and a tokenizer; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
