"""Ad clicks. The same functions serve batch frames and the micro-batches of a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import top_n
from clickloom.operators.skew import filter_by_keys

# Fixed value: clicks on one ad by one user in one day that put the user on the blacklist.
BLACKLIST_THRESHOLD = 100
# Fixed value: the end of year 9999. Times outside 1970 to then are taken as malformed.
LAST_MILLIS = 253_402_300_799_999


def _parsed(lines: DataFrame) -> DataFrame:
    """Typed columns of `<epoch millis> <province> <city> <user id> <ad id>` lines."""
    part = F.split("value", " ")

    def field(i: int) -> Column:
        return F.get(part, F.lit(i))

    millis = field(0).try_cast("bigint")
    click_time = F.when(millis.between(0, LAST_MILLIS), F.timestamp_millis(millis))
    return lines.select(
        "value",
        click_time.alias("click_time"),
        F.to_date(click_time).alias("date"),
        field(1).alias("province"),
        field(2).alias("city"),
        field(3).try_cast("bigint").alias("user_id"),
        field(4).try_cast("bigint").alias("ad_id"),
    )


def _well_formed() -> Column:
    return F.col("click_time").isNotNull() & F.col("user_id").isNotNull() & F.col("ad_id").isNotNull()


def parse_ad_log(lines: DataFrame) -> DataFrame:
    """Clicks of all well-formed lines."""
    return _parsed(lines).where(_well_formed()).drop("value")


def malformed_ad_log(lines: DataFrame) -> DataFrame:
    """Lines `parse_ad_log` leaves out."""
    return _parsed(lines).where(~_well_formed()).select("value")


def without_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users who are not on the blacklist (a stored table)."""
    return filter_by_keys(clicks, blacklist, "user_id", "left_anti")


def user_ad_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, user and ad."""
    return clicks.groupBy("date", "user_id", "ad_id").agg(F.count("*").alias("click_count"))


def users_to_blacklist(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Distinct users who reached the threshold for some ad on some day."""
    return counts.where(F.col("click_count") >= threshold).select("user_id").distinct()


def ad_totals(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return clicks.groupBy("date", "province", "city", "ad_id").agg(F.count("*").alias("click_count"))


def province_top_ads(totals: DataFrame, n: int = 3) -> DataFrame:
    """The n most-clicked ads per day and province; ties go to the smaller ad id."""
    by_province = totals.groupBy("date", "province", "ad_id").agg(F.sum("click_count").alias("click_count"))
    ranked = top_n(by_province, ["date", "province"], [F.desc("click_count"), F.asc("ad_id")], n)
    return ranked.select("date", "province", "ad_id", "click_count")


def minute_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad, keyed by the minute's start."""
    return clicks.groupBy(
        F.date_trunc("minute", "click_time").alias("minute_start"), "ad_id"
    ).agg(F.count("*").alias("click_count"))


def click_trend(minutes: DataFrame) -> DataFrame:
    """Trend rows (date, hour, minute, ad_id, click_count) of per-minute counts."""
    return minutes.select(
        F.to_date("minute_start").alias("date"),
        F.date_format("minute_start", "HH").alias("hour"),
        F.date_format("minute_start", "mm").alias("minute"),
        "ad_id",
        "click_count",
    )


def trailing_minutes(minutes: DataFrame, length: str = "60 minutes") -> DataFrame:
    """Per-minute counts inside the window that ends with the newest minute."""
    newest = minutes.agg(F.max("minute_start").alias("newest")).scalar()
    return minutes.where(F.col("minute_start") > newest - F.expr(f"INTERVAL {length}"))


def sliding_clicks(clicks: DataFrame, length: str = "60 minutes", slide: str = "10 seconds") -> DataFrame:
    """Clicks per ad in sliding windows.

    A click belongs to length/slide windows, so clicks are counted per slide first and only those
    counts are repeated. `length` must be a multiple of `slide`.
    """
    slots = clicks.groupBy(F.window("click_time", slide).alias("slot"), "ad_id").agg(
        F.count("*").alias("click_count")
    )
    # On a stream the second count takes its event time, and so its watermark, from the first one's windows.
    windows = slots.groupBy(F.window(F.window_time("slot"), length, slide).alias("window"), "ad_id")
    return windows.agg(F.sum("click_count").alias("click_count")).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "ad_id",
        "click_count",
    )
