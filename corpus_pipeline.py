"""A training-data pipeline over ``documents``: rules, near copies, benchmark leaks, secrets, tokens.

Each stage gets what the one before kept and returns the columns of ``documents``; the last adds ``piece_ids``,
``n_pieces`` and ``lossless``. Null texts and ids, repeated rows and extra columns are treated as the operators say: documents
without words fail the rules, rows that share an id stay or go together, and other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch import session
from tidewatch.llm import decontaminate, neardup, pieces, quality, secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return neardup.firsts(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` counted again."""
    return secrets.redact(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their pieces, which decode to the text."""
    return pieces.encode(docs, variants=None)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secret_scan", secret_scan),
    ("sentence_pieces", sentence_pieces),
]

#: SQL can't express near copies, spans or segmentations in one query; the tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again as the next one's documents."""
    session.configure(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = session.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
