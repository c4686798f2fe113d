"""Session roll-ups, the session filter and its statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.numbers import STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS, inside, ratio
from clickloom.functions.predicates import any_listed, equal_to, in_range, one_of
from clickloom.functions.text import seconds_between
from clickloom.operators.skew import filter_by_keys
from clickloom.session import shared_table
from clickloom.sources.tasks import JobParams


def session_rollup(actions: DataFrame) -> DataFrame:
    """One row per session: user, keywords, clicked categories, start, visit and step length.

    Lists hold exact distinct values in ascending order, joined by commas.
    """
    keyword = F.when(F.col("search_keyword") != "", F.col("search_keyword"))
    categories = F.array_sort(F.collect_set("click_category_id")).cast("array<string>")
    return (
        actions.groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.array_join(F.array_sort(F.collect_set(keyword)), ",").alias("search_keywords"),
            F.array_join(categories, ",").alias("click_category_ids"),
            F.min("action_time").alias("start_time"),
            F.max("action_time").alias("end_time"),
            F.count("*").alias("step_length"),
        )
        .withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time")))
    )


def session_measures(
    actions: DataFrame, keywords: Sequence[str] | None = None, category_ids: Sequence[int] | None = None
) -> DataFrame:
    """One row per session with the measures the filter and the statistics need.

    Keyword and category conditions become one flag each, so nothing but fixed-width values is
    aggregated and shuffled, and even a session with a large share of all actions is one row per
    task.
    """

    def any_row(condition: Column) -> Column:
        return F.coalesce(F.max(condition), F.lit(False))

    return (
        actions.groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("action_time").alias("start_time"),
            F.max("action_time").alias("end_time"),
            F.count("*").alias("step_length"),
            any_row(any_listed(F.col("search_keyword"), keywords)).alias("keyword_hit"),
            any_row(one_of(F.col("click_category_id"), category_ids)).alias("category_hit"),
        )
        .withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time")))
    )


def with_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions joined to their users; sessions of unknown users are dropped."""
    profile = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(profile, "user_id")


def filter_sessions(sessions: DataFrame, users: DataFrame, params: JobParams) -> DataFrame:
    """Known-user sessions that meet every given parameter.

    Works on `session_rollup` (comma lists) as well as on the measures, where keyword and category
    matches were already decided. Profile conditions reach the user scan.
    """
    joined = with_user(sessions, users).where(
        in_range(F.col("age"), params.start_age, params.end_age)
        & one_of(F.col("professional"), params.professionals)
        & one_of(F.col("city"), params.cities)
        & equal_to(F.col("sex"), params.sex)
    )
    if "keyword_hit" in sessions.columns:
        return joined.where(F.col("keyword_hit") & F.col("category_hit")).drop("keyword_hit", "category_hit")
    return joined.where(
        any_listed(F.col("search_keywords"), params.keywords)
        & any_listed(F.col("click_category_ids"), params.category_ids)
    )


def session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the given sessions, action columns only."""
    ids = shared_table(sessions.select("session_id"), "session-ids")
    return filter_by_keys(actions, ids, "session_id", "left_semi")


def detail_of_matching(actions: DataFrame, sessions: DataFrame, condition: Column) -> DataFrame:
    """Actions of the sessions in a stored table that meet `condition`.

    The condition stays above the stored table's scan, so that Spark can plant a Bloom filter of the
    session ids (`might_contain`) into the action scan, below its shuffle, when the actions are large
    and the matching ids few (`spark.sql.optimizer.runtime.bloomFilter.*`).
    """
    ids = sessions.where(condition).select("session_id")
    return actions.join(ids, "session_id", "left_semi").select(*actions.columns)


def _buckets() -> list[tuple[str, Column]]:
    """Name and condition of every visit-length and step-length bucket."""
    groups = [("visit_length", VISIT_LENGTH_BUCKETS), ("step_length", STEP_LENGTH_BUCKETS)]
    return [(f"{m}_{label}", inside(F.col(m), low, high)) for m, buckets in groups for label, low, high in buckets]


def bucket_counts() -> list[Column]:
    """Aggregates: the number of sessions, and of those in every bucket."""
    return [F.count("*").alias("session_count"), *(F.count(F.when(hit, 1)).alias(name) for name, hit in _buckets())]


def _ratios(counts: DataFrame) -> DataFrame:
    shares = [ratio(F.col(name), F.col("session_count")).alias(f"{name}_ratio") for name, _ in _buckets()]
    return counts.select("session_count", *shares)


def session_stats(sessions: DataFrame) -> DataFrame:
    """One row: session count and the share of every visit-length and step-length bucket."""
    return _ratios(sessions.agg(*bucket_counts()))


def observed_sessions(sessions: DataFrame) -> tuple[DataFrame, Observation]:
    """Sessions that count themselves while an action runs over them: buckets as in `session_stats`.

    The counts are those of the action's result tasks, each counted once however often it was tried.
    """
    observation = Observation("session-buckets")
    return sessions.observe(observation, *bucket_counts()), observation


def stats_of_observed(spark: SparkSession, observation: Observation) -> DataFrame:
    """`session_stats` from what was counted; waits for the first action over the observed sessions."""
    counts = {name: int(n) for name, n in observation.get.items()}
    return _ratios(spark.createDataFrame([counts], ", ".join(f"{name} bigint" for name in counts)))
