"""The corpus pipeline: stages over `documents`, each of which takes what the one before kept.

Only the last stage changes the columns. Between stages the rows are written as Parquet in the
shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import packing, repetition, secrets, simhash, weak_labels
from wayfare.llm.common import table
from wayfare.session import configure, materialise

# No SQL states the stages: they tokenise, search suffix arrays and fit models.
ORACLE_SQL: str | None = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rule or repeat themselves too much."""
    return repetition.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the weak-label classifier finds to be junk or toxic."""
    return weak_labels.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one of the smallest doc_id."""
    return simhash.keep_first(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in texts, but for widely copied examples."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences; one row per piece."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
