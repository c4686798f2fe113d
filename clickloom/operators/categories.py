"""Category activity: clicks, orders and payments per category, and the most popular ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.predicates import any_listed, one_of
from clickloom.functions.text import id_list, seconds_between
from clickloom.operators.ranking import top_n

KINDS = ("click", "order", "pay")
VISIT = "visit"


def _stacked(actions: DataFrame, keep: Sequence[str], visits: bool) -> DataFrame:
    """One (kind, category_id) row per category of an action; with `visits`, one more without a category."""
    no_id, no_list = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    kinds = [
        *([F.lit(VISIT), no_id, no_list] if visits else []),
        *[F.lit("click"), F.col("click_category_id"), no_list],
        *[F.lit("order"), no_id, F.col("order_category_ids")],
        *[F.lit("pay"), no_id, F.col("pay_category_ids")],
    ]
    is_visit = F.col("kind") == VISIT
    rows = actions.select(*keep, F.stack(F.lit(len(kinds) // 3), *kinds).alias("kind", "_one", "_list"))
    rows = rows.where(is_visit | F.col("_one").isNotNull() | F.col("_list").isNotNull())
    parts = rows.select(*keep, "kind", "_one", F.explode_outer(id_list(F.col("_list"))).alias("_part"))
    category = F.coalesce(F.col("_one"), F.col("_part").try_cast("bigint"))
    entries = parts.select(*keep, "kind", category.alias("category_id"))
    return entries.where(is_visit | F.col("category_id").isNotNull())


def category_entries(actions: DataFrame, *keep: str) -> DataFrame:
    """Stack clicks, orders and payments: one (kind, category_id) row per category of an action.

    An id list counts once per element. The actions are read once.
    """
    return _stacked(actions, keep, visits=False)


def _kind_counts() -> list[Column]:
    return [F.count(F.when(F.col("kind") == kind, 1)).alias(f"{kind}_count") for kind in KINDS]


def category_universe(actions: DataFrame) -> DataFrame:
    """Every category that was clicked, ordered or paid for."""
    return category_entries(actions).select("category_id").distinct()


def category_kind_counts(actions: DataFrame) -> DataFrame:
    """Rows (category_id, kind, row_count) for the kinds click, order and pay."""
    return category_entries(actions).groupBy("category_id", "kind").agg(F.count("*").alias("row_count"))


def category_counts(actions: DataFrame) -> DataFrame:
    """Click, order and pay count of every category in one aggregation; absent kinds count 0."""
    return category_entries(actions).groupBy("category_id").agg(*_kind_counts())


def session_category_facts(actions: DataFrame) -> DataFrame:
    """The same counts per session and category.

    They are combined before the shuffle, so a session of any size has at most one row per category
    and task.
    """
    return category_entries(actions, "session_id").groupBy("session_id", "category_id").agg(*_kind_counts())


def session_activity(
    actions: DataFrame, keywords: Sequence[str] | None = None, category_ids: Sequence[int] | None = None
) -> DataFrame:
    """`session_measures` and `session_category_facts` from one scan and one shuffle.

    A session has one row with a NULL category, which holds the measures, and one for each
    category, which holds the counts. Rows combine before the shuffle.
    """
    flagged = actions.select(
        "*",
        any_listed(F.col("search_keyword"), keywords).alias("_keyword"),
        one_of(F.col("click_category_id"), category_ids).alias("_category"),
    )
    entries = _stacked(flagged, ["session_id", "user_id", "action_time", "_keyword", "_category"], visits=True)
    activity = entries.groupBy("session_id", "category_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.when(F.col("kind") == VISIT, 1)).alias("step_length"),
        F.coalesce(F.max("_keyword"), F.lit(False)).alias("keyword_hit"),
        F.coalesce(F.max("_category"), F.lit(False)).alias("category_hit"),
        *_kind_counts(),
    )
    return activity.withColumn("visit_length", seconds_between(F.col("start_time"), F.col("end_time")))


def measures_from_activity(activity: DataFrame) -> DataFrame:
    counts = [f"{kind}_count" for kind in KINDS]
    return activity.where(F.col("category_id").isNull()).drop("category_id", *counts)


def facts_from_activity(activity: DataFrame) -> DataFrame:
    rows = activity.where(F.col("category_id").isNotNull())
    return rows.select("session_id", "category_id", *[f"{kind}_count" for kind in KINDS])


def category_counts_from_facts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("category_id").agg(*[F.sum(f"{kind}_count").alias(f"{kind}_count") for kind in KINDS])


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """The n categories with most clicks, then orders, then payments; ties go to the smaller id."""
    counted = [f"{kind}_count" for kind in KINDS]
    order = [F.desc(name) for name in counted]
    return counts.select("category_id", *counted).orderBy(*order, F.asc("category_id")).limit(n)


def session_category_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per (category, session)."""
    return (
        actions.where(F.col("click_category_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
        .agg(F.count("*").alias("click_count"))
    )


def within_categories(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Rows of the given top categories. `categories` is a top-n report, so it fits a broadcast."""
    return rows.join(categories.select("category_id"), "category_id", "left_semi")


def top_sessions(clicks: DataFrame, n: int = 10) -> DataFrame:
    """The n sessions with most clicks in every category; ties go to the smaller session id."""
    ranked = top_n(clicks, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n)
    return ranked.select("category_id", "session_id", "click_count")


def top_session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the top sessions, repeated for every category a session is listed under.

    `sessions` is the report of `top_sessions` over top categories: n x n rows at most.
    """
    listed = sessions.select("category_id", "session_id")
    return actions.join(listed, "session_id")
