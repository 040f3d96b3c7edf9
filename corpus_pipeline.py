"""From raw documents to packed training sequences, in stages that each call one operator of rangemap.llm.

A stage takes the session, the documents its predecessor kept, and the folder of the other tables. All but the last
return the columns of documents; each result is written as Parquet and reread.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangemap.llm import jaccard, packing, quality, secrets, substrings
from rangemap.llm.common import table, written


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies: five-word shingles, similarity 0.8."""
    return jaccard.keep_first(docs, k=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 13 words or more that one with a smaller id has."""
    return _measured(substrings.remove_repeats(docs))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return _measured(secrets.redact_secrets(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.best_fit(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("substring dedup", substring_stage),
    ("secret scans", secrets_stage),
    ("best-fit packing", packing_stage),
]

#: The classifier's dictionaries and the packing's bins can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
