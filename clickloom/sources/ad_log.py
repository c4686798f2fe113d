"""Ad log lines as a stream with one text column `value`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_lines(spark: SparkSession, servers: str, topics: str, **options) -> DataFrame:
    """Lines from a comma list of topics. Needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def file_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines from text files arriving in a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("value")
