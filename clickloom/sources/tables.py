"""Action and dimension tables from parquet, catalog tables, delimited text or JDBC."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.functions.text import id_list, parse_time


def read_table(spark: SparkSession, location: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table by path, or by catalog name with `fmt="table"`."""
    if fmt == "table":
        return spark.table(location)
    return spark.read.format(fmt).options(**options).load(location)


def read_delimited(spark: SparkSession, path: str, schema: str, separator: str = "\x01") -> DataFrame:
    """Delimited text whose missing values are written as `null`."""
    return spark.read.schema(schema).csv(path, sep=separator, nullValue="null")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **options,
) -> DataFrame:
    """A database table. With a partition column the read is split into ranges of `bounds`."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def user_info(df: DataFrame) -> DataFrame:
    return _conform(df, schemas.USER_INFO)


def product_info(df: DataFrame) -> DataFrame:
    return _conform(df, schemas.PRODUCT_INFO)


def city_info(df: DataFrame) -> DataFrame:
    """City dimension; the id may arrive as text or any integer type."""
    return _conform(df, schemas.CITY_INFO)


def scan_actions(actions: DataFrame, start: str | date | None, end: str | date | None) -> DataFrame:
    """Actions dated `start` to `end`, both included; a missing bound is open.

    The bound takes the column's own type, so the comparison reaches the file scan and prunes
    partitions when the table is partitioned by date.
    """
    day_type = actions.schema["date"].dataType
    for bound, keep in ((start, F.col("date").__ge__), (end, F.col("date").__le__)):
        if bound is not None:
            actions = actions.where(keep(F.lit(str(bound)).cast(day_type)))
    return actions


def typed_actions(actions: DataFrame) -> DataFrame:
    """Turn textual dates and times into real ones; typed columns pass through untouched.

    Unreadable ones become NULL; `unreadable_actions` finds them.
    """
    fields = {f.name: f.dataType for f in actions.schema}
    if isinstance(fields["date"], T.StringType):
        actions = actions.withColumn("date", F.col("date").try_cast("date"))
    if isinstance(fields["action_time"], T.StringType):
        actions = actions.withColumn("action_time", parse_time(F.col("action_time")))
    return actions


def unreadable_actions(actions: DataFrame) -> DataFrame:
    """Actions with a date, time or category id that the jobs cannot read, whole, with a comma list of `reasons`.

    The reasons are names of columns. NULLs and empty list elements are missing, not unreadable.
    """
    fields = {f.name: f.dataType for f in actions.schema}
    readers = {"date": lambda value: value.try_cast("date"), "action_time": parse_time}
    bad = {
        name: F.col(name).isNotNull() & read(F.col(name)).isNull()
        for name, read in readers.items()
        if isinstance(fields[name], T.StringType)
    }
    for name in ("order_category_ids", "pay_category_ids"):
        bad[name] = F.exists(id_list(F.col(name)), lambda x: (F.trim(x) != "") & x.try_cast("bigint").isNull())
    reasons = F.concat_ws(",", *[F.when(found, name) for name, found in bad.items()])
    return actions.withColumn("reasons", reasons).where("reasons <> ''")


def _conform(df: DataFrame, schema: str) -> DataFrame:
    wanted = T._parse_datatype_string(schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
