"""Top products per area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import group_concat_distinct
from clickloom.operators.products import (
    AREA_LEVELS,
    area_level,
    city_label,
    city_product_counts,
    product_clicks,
    top_products,
    with_city,
    with_product,
)
from clickloom.sources.tables import scan_actions
from clickloom.sources.tasks import JobParams


def area_top_products(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    params: JobParams = JobParams(),
    levels: Mapping[str, Sequence[str]] = AREA_LEVELS,
    n: int = 3,
) -> DataFrame:
    """The n most-clicked known products of every area with their cities and status.

    Clicks collapse to (city, product) counts before any join. The ranking then needs counts only;
    city lists are built just for the winners, from the same (city, product) shuffle.
    """
    actions = scan_actions(actions, params.start_date, params.end_date)
    located = with_city(city_product_counts(product_clicks(actions)), cities)
    by_area = located.groupBy("area", "product_id").agg(F.sum("click_count").alias("click_count"))
    winners = top_products(with_product(by_area, products), n)
    winners = winners.select("area", "product_id", "product_name", "product_status")
    infos = (
        located.join(winners, ["area", "product_id"])
        .groupBy("area", "product_id", "product_name", "product_status")
        .agg(
            F.sum("click_count").alias("click_count"),
            group_concat_distinct(city_label()).alias("city_infos"),
        )
    )
    return infos.select(
        "area",
        area_level(F.col("area"), levels).alias("area_level"),
        "product_id",
        "city_infos",
        "click_count",
        "product_name",
        "product_status",
    )
