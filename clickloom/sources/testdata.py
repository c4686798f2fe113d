"""Click-stream tables derived from the test tables, so every operator runs on given data.

`acceptance/oracle.py` states the same derivation in SQL.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Levels for the regions that stand in for areas.
REGION_LEVELS = {
    "A Level": ["AFRICA", "AMERICA"],
    "B Level": ["ASIA"],
    "C Level": ["EUROPE"],
}
# Given schemas spare a look into the files before every query.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _key() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _when(event_type: str, value: Column) -> Column:
    return F.when(F.col("event_type") == event_type, value)


def actions(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Actions of the `events` table; a session is one user's day. Date bounds reach the file scan."""
    events = table(spark, sf_dir, "events")
    if start:
        events = events.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        after = date.fromisoformat(end) + timedelta(days=1)
        events = events.where(F.col("ts") < F.lit(str(after)).cast("timestamp_ntz"))
    keyed = events.withColumn("k", _key())
    k = F.col("k")
    listed = F.concat_ws(",", k.cast("string"), (k * 7 % 100).cast("string"))
    return keyed.select(
        F.to_date("ts").alias("date"),
        "user_id",
        F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        (k % 10).alias("page_id"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("action_time"),
        _when("view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        _when("click", k).alias("click_category_id"),
        _when("click", F.col("event_id") % 100).alias("click_product_id"),
        _when("signup", listed).alias("order_category_ids"),
        _when("signup", listed).alias("order_product_ids"),
        _when("purchase", listed).alias("pay_category_ids"),
        _when("purchase", listed).alias("pay_product_ids"),
        (F.col("user_id") % 25).alias("city_id"),
        "event_id",
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(18) + key % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (F.col("p_partkey") % 2).cast("string")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), status, F.lit("}")).alias("extend_info"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per customer, asking about the customer's own profile."""
    key = F.col("c_custkey")
    age = F.lit(18) + key % 50

    def one(value) -> Column:
        return F.array(value)

    document = F.to_json(
        F.struct(
            one(F.lit("2024-01-01")).alias("startDate"),
            one(F.lit("2024-01-30")).alias("endDate"),
            one((age - 5).cast("string")).alias("startAge"),
            one((age + 5).cast("string")).alias("endAge"),
            one(F.concat_ws(",", F.col("c_mktsegment"), F.lit("STUDENT"))).alias("professionals"),
            F.when(key % 3 == 0, one(F.lit(""))).alias("cities"),
            F.when(key % 2 == 0, one(F.lit("male"))).otherwise(F.array().cast("array<string>")).alias("sex"),
            one(F.lit("1,2,3")).alias("targetPageFlow"),
        )
    )
    return table(spark, sf_dir, "customer").select(
        key.alias("task_id"),
        F.concat(F.lit("task "), F.col("c_name")).alias("task_name"),
        document.alias("task_param"),
    )


def ad_lines(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Ad log lines of the click events; works on a stream of events as well."""
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("_city"),
        F.regexp_replace("r_name", " ", "-").alias("_province"),
        F.col("n_name").alias("_name"),
    )
    clicks = events.where(F.col("event_type") == "click").withColumn("_city", F.col("user_id") % 25)
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return clicks.join(places, "_city").select(
        F.concat_ws(
            " ", millis, "_province", "_name", F.col("user_id").cast("string"), (_key() % 10).cast("string")
        ).alias("value")
    )


def ad_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_lines(*(table(spark, sf_dir, name) for name in ("events", "nation", "region")))


def ad_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as a file stream."""
    events = (
        spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    return ad_lines(events, table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))
