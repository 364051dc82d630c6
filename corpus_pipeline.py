"""From raw documents to packed training sequences, in stages that each rewrite the table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from remitlens.llm import exact, quality_rules, queries, secret_scan, simhash
from remitlens.llm.common import table
from remitlens.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail a quality rule go."""
    return quality_rules.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of equal texts stays: the smallest doc_id."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near copies stays: the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return secret_scan.redact(docs, secret_scan.BlobLedger(spark))


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document's pieces, token ids and all, with their place in a training sequence."""
    return queries.packed(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("packing", packing),
]

#: Fingerprints, groups of near copies and token ids are not SQL's; the tests hold the rows against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again as the next one's."""
    docs = table(spark, folder, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if number < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
