"""Result tables, with the rows of every task in a partition of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TASK = "task_id"
# Takes a table name, a task id and the task's rows of that table.
Sink = Callable[[str, int, DataFrame], None]


def folder_sink(root: str) -> Sink:
    """Parquet tables below one folder; a task that runs again replaces its rows."""
    return lambda name, task_id, rows: write_task(rows, f"{root}/{name}", task_id)


def jdbc_sink(url: str, **options) -> Sink:
    """Tables of one database, which are appended to."""
    return lambda name, task_id, rows: append_jdbc(with_task(rows, task_id), url, name, **options)


def with_task(result: DataFrame, task_id: int) -> DataFrame:
    return result.select(F.lit(task_id).cast("bigint").alias(TASK), "*")


def write_task(rows: DataFrame, path: str, task_id: int) -> None:
    """Rows of one task in a parquet table; other tasks keep theirs."""
    rows.write.mode("overwrite").parquet(f"{path}/{TASK}={task_id}")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """A result table of all tasks, the task id first."""
    found = spark.read.parquet(path)
    return found.select(F.col(TASK).cast("bigint"), *[c for c in found.columns if c != TASK])


def append_jdbc(rows: DataFrame, url: str, table: str, connections: int = 8, batch_size: int = 10_000, **options) -> None:
    """Append to a database table through at most `connections` connections."""
    rows.write.format("jdbc").options(
        url=url, dbtable=table, numPartitions=connections, batchsize=batch_size, **options
    ).mode("append").save()
