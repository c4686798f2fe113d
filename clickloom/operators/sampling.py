"""Time-proportional random sample of sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.ranking import top_n


def hourly_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions started per date and hour of day."""
    return sessions.groupBy(
        F.to_date("start_time").alias("date"), F.hour("start_time").alias("hour")
    ).agg(F.count("*").alias("session_count"))


def hourly_quotas(hours: DataFrame, total: int = 100) -> DataFrame:
    """How many sessions to draw per hour.

    Every date gets total // dates. An hour gets its share of the date's sessions times that,
    in floating point and cut to an integer, and never more than it has.
    """
    dates = hours.agg(F.countDistinct("date").alias("dates")).scalar()
    per_day = F.call_function("div", F.lit(total).cast("bigint"), dates)
    day_count = F.sum("session_count").over(Window.partitionBy("date"))
    share = F.col("session_count").cast("double") / day_count.cast("double")
    quota = F.floor(share * per_day.cast("double")).cast("bigint")
    return hours.select("date", "hour", F.least(quota, F.col("session_count")).alias("quota"))


def sample_sessions(sessions: DataFrame, total: int = 100, seed: str = "0") -> DataFrame:
    """At most `total` sessions, spread over dates and hours as the sessions are.

    The order inside an hour is that of md5(seed, session id): uniform, and the same on every run.
    No hour can be granted more than `total`, so each is first cut to its first `total` sessions,
    which Spark does before the shuffle, and only those meet their quota. `sessions` is read more
    than once and should be a stored table.
    """
    quotas = hourly_quotas(hourly_sessions(sessions), total)
    timed = sessions.withColumn("date", F.to_date("start_time")).withColumn("hour", F.hour("start_time"))
    timed = timed.withColumn("_draw", F.md5(F.concat(F.lit(seed), F.col("session_id"))))
    order = [F.asc("_draw"), F.asc("session_id")]
    candidates = top_n(timed, ["date", "hour"], order, total, "_rank")
    drawn = candidates.join(quotas, ["date", "hour"]).where(F.col("_rank") <= F.col("quota"))
    return drawn.drop("_draw", "_rank", "quota", "date", "hour")
