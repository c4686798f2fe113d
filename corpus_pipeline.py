"""From raw documents to packed token sequences, as stages that each read what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm.decontaminate import drop_leaks
from clickloom.llm.near_dedup import drop_near_duplicates
from clickloom.llm.packing import pack
from clickloom.llm.secrets import redact
from clickloom.llm.toxicity import drop_toxic
from clickloom.session import shared_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five-word shingles, similarity 0.8), the smallest doc_id stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blotted out; every document stays."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_redaction", secret_redaction),
    ("packing", packing),
]

#: SQL can express none of the models; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs
