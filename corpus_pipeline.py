"""A training corpus out of raw documents: stages that each read what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.exact_dedup import deduplicate
from tidemark.llm.jaccard import drop_near_copies
from tidemark.llm.mixing import mix_documents
from tidemark.llm.packing import pack_texts
from tidemark.llm.toxicity import drop_toxic
from tidemark.session import work_path

NEAR_WORDS, NEAR_THRESHOLD = 5, (8, 10)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the network learns from ``labels`` outside its held-out fold."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return deduplicate(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays: sets of five-word shingles, linked at 0.8 and more."""
    return drop_near_copies(docs, NEAR_WORDS, NEAR_THRESHOLD)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated or thinned to their targets; a repeated document is a repeated row."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their ids, and the sequence and place of each."""
    return pack_texts(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("mixing", mixing),
    ("packing", packing),
]

# Scores of a trained model are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next."""
    docs, base = table(spark, sf_dir, "documents"), work_path(spark, "corpus")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{base}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
