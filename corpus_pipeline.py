"""A corpus pipeline of five operators over ``documents``.

Each stage takes what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from parley.llm import line_dedup, near_dedup, packing, quality_classifier, secrets
from parley.llm.queries import vocabulary
from parley.session import remove, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; no document does."""
    return line_dedup.cleaned(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return near_dedup.keep_one(docs)


def scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences."""
    return packing.pack(docs, vocabulary())


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("near_dedup", near), ("secret_scan", scan), ("packing", pack)]

#: Training, hashing and encoding are beyond SQL; the tests hold a brute-force version against the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what they pass on lies in the cluster's shared folder.

    A stage's table is removed once the next one's is written; that of the last
    but one stays, for the result is read from it. Rows that repeat a doc_id are
    documents of their own in every stage; null texts and null ids go through.
    """
    at = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    before = None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
        if before:
            remove(spark, before)
        before = f"{at}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
