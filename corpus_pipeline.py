"""Training-data pipeline: quality rules, near duplicates, decontamination, secrets, mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entrotree.llm import decontaminate, mixing, quality, secrets, simhash
from entrotree.llm.common import read_table
from entrotree.runtime import checkpoint_dir


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """All columns of a document as ``_doc``, beside those an operator reads.

    So a column of the table cannot clash with one that an operator adds.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(_packed(docs, "doc_id", "text"), read_table(spark, sf_dir, "labels")).select("_doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(_packed(docs, "doc_id", "text")).select("_doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    clean = decontaminate.drop_contaminated(_packed(docs, "doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return clean.select("_doc.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret found replaced by a mark; n_chars follows a changed text."""
    redacted = secrets.redact(_packed(docs, "doc_id", "text", "n_chars"))
    changed = ("text", "n_chars")
    return redacted.select(*[F.col(c) if c in changed else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes (0: none)."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
]

#: No SQL can express the stages; tests/llm checks them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared folder."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
