"""Training-corpus pipeline: five stages from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet in the shared folder and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``. The classifiers learn from the labelled
documents among their own input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import exact_dedup, near_dup, packing, quality, toxicity
from ledgerline.llm.common import importable, table, written
from ledgerline.llm.queries import TOKENIZER


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    importable(spark)
    return quality.keep_good(docs, quality.train(spark, docs, table(spark, sf_dir, "labels")))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    importable(spark)
    return toxicity.keep_clean(docs, toxicity.train(spark, docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every text."""
    return exact_dedup.drop_copies(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies."""
    importable(spark)
    return near_dup.drop_near_copies(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences."""
    importable(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("toxicity", keep_clean),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: SQL expresses neither the classifiers nor the signatures: the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
