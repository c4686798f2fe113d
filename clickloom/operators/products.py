"""Most-clicked products per area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import concat_long_string, group_concat_distinct, json_field
from clickloom.operators.ranking import top_n

# Areas of each level; any other area is of the last level.
AREA_LEVELS = {
    "A Level": ["China North", "China East"],
    "B Level": ["China South", "China Middle"],
    "C Level": ["West North", "West South"],
}
OTHER_LEVEL = "D Level"
SELF_OPERATED = "Self"
THIRD_PARTY = "Third Party"


def product_clicks(actions: DataFrame) -> DataFrame:
    """City and product of every product click."""
    return actions.where(F.col("click_product_id").isNotNull()).select(
        "city_id", F.col("click_product_id").alias("product_id")
    )


def with_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with the name and area of their city; clicks from unknown cities are dropped."""
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id")


def city_product_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (city, product). Collapses a busy city before anything is joined to it."""
    return clicks.groupBy("city_id", "product_id").agg(F.count("*").alias("click_count"))


def area_product_counts(city_products: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per (area, product) with the distinct `id:name` list of the cities they came from."""
    return (
        with_city(city_products, cities)
        .groupBy("area", "product_id")
        .agg(
            F.sum("click_count").alias("click_count"),
            group_concat_distinct(city_label()).alias("city_infos"),
        )
    )


def city_label() -> Column:
    return concat_long_string(F.col("city_id"), F.col("city_name"), ":")


def product_status(extend_info: Column) -> Column:
    status = json_field(extend_info, "product_status")
    return F.when(status == "0", SELF_OPERATED).otherwise(THIRD_PARTY)


def with_product(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Counts with product name and status; unknown products are dropped."""
    described = products.select(
        "product_id", "product_name", product_status(F.col("extend_info")).alias("product_status")
    )
    return counts.join(described, "product_id")


def area_level(
    area: Column, levels: Mapping[str, Sequence[str]] = AREA_LEVELS, other: str = OTHER_LEVEL
) -> Column:
    label = F.lit(other)
    for level, areas in reversed(list(levels.items())):
        label = F.when(area.isin(list(areas)), level).otherwise(label)
    return label


def top_products(counts: DataFrame, n: int = 3) -> DataFrame:
    """The n most-clicked products of every area; ties go to the smaller product id."""
    return top_n(counts, ["area"], [F.desc("click_count"), F.asc("product_id")], n)
