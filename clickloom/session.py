"""Spark session settings and the shared folder for frames that several results read."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings this library relies on. Adaptive execution re-plans joins from measured shuffle sizes
# and splits skewed join partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    STATE_STORE: ROCKSDB,
    # Bloom filters into scans from this size on, rather than from 10 GB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
}


def build_session(app_name: str = "clickloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above. `conf` keys use `__` for `.`; master is left to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started meanwhile keep their state in RocksDB, whatever the session is set to.

    A stream copies the session's settings when it starts, and its checkpoint keeps the choice.
    """
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in `spark.checkpoint.dir`.

    Where that is unset, a folder in the warehouse. A warehouse on a local disk is refused unless all
    tasks run on the driver's machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE_DIR)
    if not spark.sparkContext.master.startswith("local") and warehouse.split(":", 1)[0] in ("file", warehouse):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors reach: {warehouse} may be each machine's own")
    return f"{warehouse}/_shared".rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (nothing is created yet)."""
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear_shared(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder, once its results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/clickloom/{spark.sparkContext.applicationId}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Results that share a frame then read columnar files instead of repeating its shuffles, and
    a lost executor costs a re-read rather than the lineage.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
