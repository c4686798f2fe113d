"""The operators as queries over the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    byte_bpe,
    conversations,
    decontaminate,
    language_id,
    licences,
    near_dedup,
    packing,
    secrets,
    substring_dedup,
    toxicity,
    vp_search,
    warc,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vp_search.usable_vectors(_table(spark, sf_dir, "embeddings"))
    return vp_search.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages")).drop("archive")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    return found.withColumn("value_sha256", F.sha2(F.col("value").cast("binary"), 256)).drop("value")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), near_dedup.NearDedupParams(shingle_words=2))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(byte_bpe.round_trip(_table(spark, sf_dir, "documents")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_vp_tree_search,
            op2_substring_dedup,
            op3_toxicity,
            op4_warc,
            op5_packing,
            op6_language_id,
            op7_decontamination,
            op8_licence_scan,
            op9_secret_scan,
            op10_near_dedup,
            op11_byte_bpe,
            op12_whitening,
            op13_conversation_repair,
            pipeline,
        )
    }


def statements() -> dict[str, str]:
    """Only the licence scan is plain SQL; the others are tested against brute force or on held-out rows."""
    return {"op8_licence_scan": licences.scan_sql()}
