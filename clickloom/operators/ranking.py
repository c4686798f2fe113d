"""First n rows of every group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """Rows ranked 1..n per group by row_number.

    A literal `rank <= n` lets Spark limit each group per task, so a hot group reaches its reducer
    with n rows per task.
    """
    return _ranked(df, group, order, n, rank)


def _ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
