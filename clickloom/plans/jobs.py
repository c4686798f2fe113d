"""The batch jobs as they are run: parameters from the task table, results in one table each."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.plans.area_products import area_top_products
from clickloom.plans.page_conversion import page_conversion_row
from clickloom.plans.session_analysis import SessionAnalysis
from clickloom.sinks.append import Sink
from clickloom.sources.tasks import load_job_params


def run_session_job(actions: DataFrame, users: DataFrame, tasks: DataFrame, task_id: int, sink: Sink) -> None:
    result = SessionAnalysis(actions, users, load_job_params(tasks, task_id))
    # Both details go to the same table, and a session may be in both.
    detail = result.sample_detail.unionByName(result.top_session_detail.drop("category_id"))
    for name, rows in (
        ("session_aggr_stat", result.stats),
        ("session_random_extract", result.sample),
        ("session_detail", detail),
        ("top10_category", result.top_categories),
        ("top10_session", result.top_sessions),
    ):
        sink(name, task_id, rows)


def run_page_job(
    actions: DataFrame, tasks: DataFrame, task_id: int, sink: Sink, tie_break: tuple[str, ...] = ()
) -> None:
    """`tie_break` orders actions of one second; without it, hops from or to such a second do not count."""
    sink("page_split_convert_rate", task_id, page_conversion_row(actions, load_job_params(tasks, task_id), tie_break))


def run_product_job(
    actions: DataFrame, cities: DataFrame, products: DataFrame, tasks: DataFrame, task_id: int, sink: Sink
) -> None:
    best = area_top_products(actions, cities, products, load_job_params(tasks, task_id))
    sink("area_top3_product", task_id, best)
