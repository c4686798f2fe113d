"""Actions laid out by session: a table that session work reads without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_by_session(actions: DataFrame, name: str, path: str, buckets: int = 64) -> DataFrame:
    """Store actions as the catalog table `name`, bucketed by session and sorted by session and time.

    The one shuffle is paid here; roll-ups, page steps and semi joins by session of what is read back
    need none. Choose `buckets` so that a bucket fits a task: one session is always in one bucket, so
    this suits sessions of bounded length, as dates and time-outs make them.
    """
    placed = actions.repartition(buckets, "session_id")
    writer = placed.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, "session_id").sortBy("session_id", "action_time").saveAsTable(name)
    return actions.sparkSession.table(name)
