"""The string helpers as SQL functions, for queries written as SQL text.

They are SQL expressions, so Catalyst inlines them. `get_json_object` keeps Spark's own path
syntax; `json_field` takes a bare field name. Aggregates cannot be SQL functions: write
`listagg(DISTINCT c, ',') WITHIN GROUP (ORDER BY c)` for `group_concat_distinct`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FUNCTIONS = [
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(number BIGINT, txt STRING, separator STRING)
       RETURNS STRING
       RETURN concat(coalesce(cast(number AS STRING), 'null'), separator, coalesce(txt, 'null'))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION json_field(document STRING, field STRING)
       RETURNS STRING
       RETURN get_json_object(document, concat("$['", field, "']"))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION random_prefix(val STRING, cnt INT)
       RETURNS STRING
       RETURN concat(cast(cast(floor(rand() * cnt) AS INT) AS STRING), '_', val)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION remove_random_prefix(val STRING)
       RETURNS STRING
       RETURN regexp_replace(val, '^[0-9]+_', '')""",
]


#: The jobs as table functions over the views `actions`, `city_info` and `product_info`.
TABLE_FUNCTIONS = [
    """CREATE OR REPLACE TEMPORARY FUNCTION area_top_products(start_date DATE, end_date DATE, most INT)
       RETURNS TABLE (area STRING, product_id BIGINT, product_name STRING, product_status STRING, click_count BIGINT, city_infos STRING)
       RETURN
       WITH by_city AS (
         SELECT city_id, click_product_id AS product_id, count(*) AS click_count
         FROM actions WHERE date BETWEEN start_date AND end_date AND click_product_id IS NOT NULL
         GROUP BY city_id, click_product_id
       ), by_area AS (
         SELECT area, product_id, sum(click_count) AS click_count,
           listagg(DISTINCT concat(city_id, ':', city_name), ',') WITHIN GROUP (ORDER BY concat(city_id, ':', city_name)) AS city_infos
         FROM by_city JOIN city_info USING (city_id) GROUP BY area, product_id
       ), known AS (
         SELECT area, product_id, product_name, click_count, city_infos,
           CASE WHEN json_field(extend_info, 'product_status') = '0' THEN 'Self' ELSE 'Third Party' END AS product_status
         FROM by_area JOIN product_info USING (product_id)
       )
       SELECT area, product_id, product_name, product_status, click_count, city_infos
       FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS place FROM known)
       WHERE place <= most""",
    """CREATE OR REPLACE TEMPORARY FUNCTION page_conversion(page_flow STRING, start_date DATE, end_date DATE)
       RETURNS TABLE (position INT, hop STRING, hop_count BIGINT, base_count BIGINT, rate DOUBLE)
       RETURN
       WITH visits AS (
         SELECT page_id, lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS before
         FROM actions WHERE date BETWEEN start_date AND end_date AND session_id IS NOT NULL
       ), pages AS (
         SELECT i, cast(page AS BIGINT) AS page, lag(cast(page AS BIGINT)) OVER (ORDER BY i) AS before
         FROM (SELECT posexplode(split(page_flow, ',')) AS (i, page))
       ), counts AS (
         SELECT before, page_id, count(*) AS n FROM visits GROUP BY before, page_id
       ), hops AS (
         SELECT i, any_value(p.before) AS before, any_value(p.page) AS page,
           coalesce(sum(CASE WHEN i = 0 OR c.before = p.before THEN n END), 0) AS n
         FROM pages p LEFT JOIN counts c ON c.page_id = p.page GROUP BY i
       ), based AS (
         SELECT *, lag(n) OVER (ORDER BY i) AS base FROM hops
       )
       SELECT i, concat(before, '_', page), n, base, div(200 * n + base, nullif(2 * base, 0)) / 100.0D FROM based WHERE i > 0""",
]


def register_table_functions(spark: SparkSession, actions: DataFrame, cities: DataFrame, products: DataFrame) -> None:
    """`area_top_products(start, end, most)` and `page_conversion(flow, start, end)` for SQL text.

    They are SQL, so Catalyst plans a call as if its text stood there; the windows over `pages` are of
    the flow's few rows. Actions at one second are ordered by their `event_id`.
    """
    register_functions(spark)
    for name, frame in (("actions", actions), ("city_info", cities), ("product_info", products)):
        frame.createOrReplaceTempView(name)
    for statement in TABLE_FUNCTIONS:
        spark.sql(statement)


def register_functions(spark: SparkSession) -> None:
    for statement in FUNCTIONS:
        spark.sql(statement)
