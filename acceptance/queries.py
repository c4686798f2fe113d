"""Every operator of the library applied to the test tables."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import text
from clickloom.functions.numbers import STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS, bucket
from clickloom.functions.predicates import any_listed, equal_to, in_range
from clickloom.functions.sql import register_functions, register_table_functions
from clickloom.operators import ads, categories, page_flow, products, sampling, sessions, skew
from clickloom.plans.area_products import area_top_products
from clickloom.plans.page_conversion import page_conversion, page_conversion_row
from clickloom.plans.session_analysis import SessionAnalysis
from clickloom.schemas import SESSION_DETAIL_COLUMNS
from clickloom.session import new_folder, shared_table
from clickloom.sinks.append import read_results, write_task
from clickloom.sources import tables, testdata
from clickloom.sources.ad_log import file_lines
from clickloom.sources.bucketed import write_by_session
from clickloom.sources.tasks import JobParams, parse_task_params, parse_task_variants
from clickloom.streaming.ad_clicks import AdClickJob

Query = Callable[[SparkSession, str], DataFrame]

FLOW = (1, 2, 3, 4, 5)
TIE_BREAK = ("event_id",)
FILTER = JobParams(
    start_age=20,
    end_age=55,
    professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"),
    cities=("city1", "city2", "city3", "city5", "city8", "city13", "city21"),
    sex="male",
    keywords=("kw1", "kw3", "kw5", "kw7"),
    category_ids=tuple(range(60)),
)
MALE_20_45 = JobParams(start_age=20, end_age=45, sex="male")
# A user's clicks on one ad in one day are few in the test tables.
THRESHOLD = 2
ONCE = {"availableNow": True}

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- helpers -------------------------------------------------------------------------------------


def as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that any engine's rows compare equal."""
    formats = {"date": "yyyy-MM-dd", "action_time": text.TIME_TEXT, "start_time": text.TIME_TEXT,
               "click_time": "yyyy-MM-dd HH:mm:ss.SSS", "minute_start": "yyyy-MM-dd HH:mm",
               "window_start": "yyyy-MM-dd HH:mm", "window_end": "yyyy-MM-dd HH:mm"}
    return df.select(
        *[F.date_format(c, formats[c]).alias(c) if c in formats else F.col(c) for c in df.columns]
    )


def session_columns(df: DataFrame, *more: str) -> DataFrame:
    return as_text(df.select("session_id", "user_id", "start_time", "visit_length", "step_length", *more))


def known_sessions(spark: SparkSession, sf: str, params: JobParams = JobParams()) -> DataFrame:
    measured = sessions.session_measures(testdata.actions(spark, sf), params.keywords, params.category_ids)
    return sessions.filter_sessions(measured, testdata.users(spark, sf), params)


def stored_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return shared_table(known_sessions(spark, sf), "sessions")


def top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return categories.top_categories(categories.category_counts(testdata.actions(spark, sf)))


def top_category_clicks(spark: SparkSession, sf: str) -> DataFrame:
    clicks = categories.session_category_clicks(testdata.actions(spark, sf))
    return categories.within_categories(clicks, top_categories(spark, sf))


def clicks_with_city(spark: SparkSession, sf: str) -> DataFrame:
    clicks = products.product_clicks(testdata.actions(spark, sf))
    return products.with_city(clicks, testdata.cities(spark, sf))


def area_counts(spark: SparkSession, sf: str) -> DataFrame:
    clicks = products.product_clicks(testdata.actions(spark, sf))
    return products.area_product_counts(products.city_product_counts(clicks), testdata.cities(spark, sf))


def ad_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return ads.parse_ad_log(testdata.ad_log(spark, sf))


def seed_users(clicks: DataFrame) -> DataFrame:
    """A blacklist to start from: users over the threshold in the first ten days."""
    early = clicks.where(F.col("date") <= F.lit("2024-01-10").cast("date"))
    return ads.users_to_blacklist(ads.user_ad_counts(early), THRESHOLD)


def steps(spark: SparkSession, sf: str) -> DataFrame:
    return page_flow.page_steps(testdata.actions(spark, sf), TIE_BREAK)


def first_half_hour(clicks: DataFrame) -> DataFrame:
    return clicks.where(F.minute("click_time") < 30)


def later_half_hour(clicks: DataFrame) -> DataFrame:
    return clicks.where(F.minute("click_time") >= 30)


def early_part(clicks: DataFrame) -> DataFrame:
    """All clicks before the middle of the month, and after it those of the first half of every hour."""
    return clicks.where((F.col("date") < F.lit("2024-01-16").cast("date")) | (F.minute("click_time") < 30))


def from_mid_month(clicks: DataFrame) -> DataFrame:
    return clicks.where(F.col("date") >= F.lit("2024-01-16").cast("date"))


def analysis(spark: SparkSession, sf: str, params: JobParams = JobParams(), sample_size: int = 100) -> SessionAnalysis:
    return SessionAnalysis(testdata.actions(spark, sf), testdata.users(spark, sf), params, sample_size)


def ad_job(spark: SparkSession) -> AdClickJob:
    return AdClickJob(root=new_folder(spark, "ad-job"), threshold=THRESHOLD, trigger=ONCE)


def filtered_job(spark: SparkSession, sf: str) -> AdClickJob:
    """Run the blacklist query over the event stream, starting from the seed blacklist."""
    job = ad_job(spark)
    job.bar_users(seed_users(ad_clicks(spark, sf)))
    job.filter_clicks(testdata.ad_log_stream(spark, sf)).awaitTermination()
    return job


def totalled_job(spark: SparkSession, sf: str) -> AdClickJob:
    """Then the totals query over the clean log."""
    job = filtered_job(spark, sf)
    job.running_totals(job.clean_clicks(spark)).awaitTermination()
    return job


def job_in_two_runs(spark: SparkSession, sf: str) -> AdClickJob:
    """The whole job over the lines of the first half of every hour, then again with the others added."""
    job, folder, lines = ad_job(spark), new_folder(spark, "ad-lines"), testdata.ad_log(spark, sf)
    minute = F.pmod(F.floor(F.split("value", " ")[0].cast("bigint") / 60_000), F.lit(60))
    for part in (minute < 30, minute >= 30):
        lines.where(part).coalesce(1).write.mode("append").text(folder)
        job.run(file_lines(spark, folder), once=True)
    return job


def trend_job(spark: SparkSession, sf: str) -> AdClickJob:
    job = ad_job(spark)
    job.click_trends(testdata.ad_log_stream(spark, sf)).awaitTermination()
    return job


def by_session(spark: SparkSession, sf: str) -> DataFrame:
    """The actions as a table bucketed by session."""
    name = f"actions_by_session_{uuid.uuid4().hex}"
    return write_by_session(testdata.actions(spark, sf), name, new_folder(spark, "by-session"), 8)


def partly_unreadable(key: str, document: str) -> Column:
    """The document, cut in the middle for every seventh key."""
    return F.when(F.col(key) % 7 == 0, F.left(document, F.lit(9))).otherwise(F.col(document))


# --- sources -------------------------------------------------------------------------------------


@query
def src1_bucketed_rollup(spark, sf):
    rolled = sessions.session_rollup(by_session(spark, sf))
    return session_columns(rolled, "search_keywords", "click_category_ids")


@query
def src4_task_variants(spark, sf):
    tasks = testdata.tasks(spark, sf)
    return parse_task_variants(tasks.withColumn("task_param", partly_unreadable("task_id", "task_param")))


@query
def src1_actions_by_date(spark, sf):
    return as_text(tables.scan_actions(testdata.actions(spark, sf), "2024-01-05", "2024-01-20"))


@query
def scl2_unreadable_actions(spark, sf):
    """Times of every fifth row are written so that no job can read them, lists of every seventh too."""
    actions = testdata.actions(spark, sf)
    time = F.col("action_time")
    styles = ("yyyy-MM-dd H:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy/MM/dd HH:mm", "yyyy-MM-dd HH:mm:ss")
    text = F.date_format(time, styles[-1])
    for i, style in enumerate(styles):
        text = F.when(F.col("event_id") % 5 == i, F.date_format(time, style)).otherwise(text)

    def spoilt(name):
        return F.when(F.col("event_id") % 7 == 0, F.concat(name, F.lit(",x"))).otherwise(F.col(name)).alias(name)

    written = actions.select(
        "event_id",
        F.col("date").cast("string").alias("date"),
        text.alias("action_time"),
        spoilt("order_category_ids"),
        spoilt("pay_category_ids"),
    )
    return tables.unreadable_actions(written).select("event_id", "reasons")


@query
def src2_user_info(spark, sf):
    return tables.user_info(testdata.users(spark, sf))


@query
def src2_product_info(spark, sf):
    return tables.product_info(testdata.products(spark, sf))


@query
def src3_city_info(spark, sf):
    return tables.city_info(testdata.cities(spark, sf))


@query
def src4_task_params(spark, sf):
    return parse_task_params(testdata.tasks(spark, sf))


@query
def src5_ad_log_stream(spark, sf):
    root = new_folder(spark, "ad-log")
    stream = testdata.ad_log_stream(spark, sf).writeStream.format("parquet")
    stream.option("checkpointLocation", f"{root}/checkpoint").trigger(**ONCE).start(f"{root}/lines").awaitTermination()
    return spark.read.parquet(f"{root}/lines")


@query
def src6_blacklist_snapshot(spark, sf):
    """The list as the first micro-batch sees it, although the batch itself extends it."""
    job = filtered_job(spark, sf)
    return job.blacklisted(spark, 0)


# --- sinks ---------------------------------------------------------------------------------------


@query
def snk1_append(spark, sf):
    path = f"{new_folder(spark, 'results')}/top10_category"
    for task_id in (1, 2, 1):  # the task that runs again replaces its rows
        write_task(top_categories(spark, sf), path, task_id)
    return read_results(spark, path)


@query
def snk2_upsert_replace(spark, sf):
    table, clicks = ad_job(spark).stat, ad_clicks(spark, sf)
    table.update(ads.ad_totals(early_part(clicks)), 0)
    table.update(ads.ad_totals(from_mid_month(clicks)), 1)
    return as_text(table.read(spark))


@query
def snk3_upsert_add(spark, sf):
    table, clicks = ad_job(spark).user_clicks, ad_clicks(spark, sf)
    table.update(ads.user_ad_counts(first_half_hour(clicks)), 0)
    table.update(ads.user_ad_counts(later_half_hour(clicks)), 1)
    table.update(ads.user_ad_counts(later_half_hour(clicks)), 1)  # a replay adds nothing
    return as_text(table.read(spark))


@query
def snk4_delete_insert(spark, sf):
    table, clicks = ad_job(spark).province_top, ad_clicks(spark, sf)
    table.replace(ads.province_top_ads(ads.ad_totals(early_part(clicks))), 0)
    table.replace(ads.province_top_ads(ads.ad_totals(from_mid_month(clicks))), 1)
    return as_text(table.read(spark))


@query
def snk5_blacklist_append(spark, sf):
    table, clicks = ad_job(spark).blacklist, ad_clicks(spark, sf)
    table.append(seed_users(clicks), 0)
    found = ads.users_to_blacklist(ads.user_ad_counts(clicks), THRESHOLD)
    table.append(found.join(table.read(spark), "user_id", "left_anti"), 1)
    return table.read(spark)


# --- filters and projections ---------------------------------------------------------------------


@query
def flt1_age_range(spark, sf):
    return testdata.users(spark, sf).where(in_range(F.col("age"), 25, 40)).select("user_id", "age")


@query
def flt2_any_match(spark, sf):
    rolled = sessions.session_rollup(testdata.actions(spark, sf))
    wanted = any_listed(F.col("search_keywords"), ["kw1", "kw4"])
    return rolled.where(wanted).select("session_id", "search_keywords")


@query
def flt3_sex_equal(spark, sf):
    return testdata.users(spark, sf).where(equal_to(F.col("sex"), "female")).select("user_id", "sex")


@query
def flt4_session_filter(spark, sf):
    return session_columns(known_sessions(spark, sf, FILTER), "age", "professional", "city", "sex")


@query
def flt5_not_null(spark, sf):
    return products.product_clicks(testdata.actions(spark, sf))


@query
def prj1_area_level(spark, sf):
    level = products.area_level(F.col("area"), testdata.REGION_LEVELS)
    return testdata.cities(spark, sf).select("city_id", "area", level.alias("area_level"))


@query
def prj2_product_status(spark, sf):
    status = products.product_status(F.col("extend_info"))
    return testdata.products(spark, sf).select("product_id", status.alias("product_status"))


@query
def prj3_buckets(spark, sf):
    rolled = sessions.session_measures(testdata.actions(spark, sf))
    return rolled.select(
        "session_id",
        "visit_length",
        bucket(F.col("visit_length"), VISIT_LENGTH_BUCKETS).alias("visit_bucket"),
        "step_length",
        bucket(F.col("step_length"), STEP_LENGTH_BUCKETS).alias("step_bucket"),
    )


@query
def prj4_parse_ad_log(spark, sf):
    return as_text(ad_clicks(spark, sf))


# --- joins ---------------------------------------------------------------------------------------


@query
def jon1_session_user(spark, sf):
    rolled = sessions.session_measures(testdata.actions(spark, sf))
    joined = sessions.with_user(rolled, testdata.users(spark, sf))
    return session_columns(joined, "age", "professional", "city", "sex")


@query
def jon2_session_detail(spark, sf):
    detail = sessions.session_detail(testdata.actions(spark, sf), known_sessions(spark, sf, MALE_20_45))
    return as_text(detail)


@query
def jon2_bucketed_session_detail(spark, sf):
    actions = by_session(spark, sf)
    passing = sessions.filter_sessions(sessions.session_measures(actions), testdata.users(spark, sf), MALE_20_45)
    detail = actions.join(passing.select("session_id"), "session_id", "left_semi")
    return as_text(detail.select(*testdata.actions(spark, sf).columns))


@query
def jon2_detail_of_matching(spark, sf):
    known = shared_table(known_sessions(spark, sf), "known-sessions")
    wanted = F.col("age").between(20, 45) & (F.col("sex") == "male")
    return as_text(sessions.detail_of_matching(testdata.actions(spark, sf), known, wanted))


@query
def jon3_sample_detail(spark, sf):
    return as_text(analysis(spark, sf, sample_size=1000).sample_detail)


@query
def jon4_category_counts(spark, sf):
    return categories.category_counts(testdata.actions(spark, sf))


@query
def jon5_top_category_sessions(spark, sf):
    return top_category_clicks(spark, sf)


@query
def jon6_top_session_detail(spark, sf):
    best = categories.top_sessions(top_category_clicks(spark, sf))
    detail = categories.top_session_detail(testdata.actions(spark, sf), best)
    return as_text(detail.select("category_id", *SESSION_DETAIL_COLUMNS))


@query
def jon7_click_city(spark, sf):
    return clicks_with_city(spark, sf)


@query
def jon8_area_product(spark, sf):
    joined = products.with_product(area_counts(spark, sf), testdata.products(spark, sf))
    return joined.drop("city_infos")


@query
def jon9_blacklist_anti(spark, sf):
    clicks = ad_clicks(spark, sf)
    return as_text(ads.without_blacklisted(clicks, shared_table(seed_users(clicks), "blacklist")))


@query
def jon10_map_join(spark, sf):
    clicks = products.product_clicks(testdata.actions(spark, sf))
    return skew.map_join(clicks, testdata.cities(spark, sf), "city_id")


@query
def jon11_skew_join(spark, sf):
    left = testdata.actions(spark, sf).select("event_id", "city_id", "page_id")
    return skew.skew_join(left, testdata.cities(spark, sf), "city_id", share=0.02, salt_by=["event_id"])


@query
def jon11_skew_semi_join(spark, sf):
    wanted = known_sessions(spark, sf, MALE_20_45).select("session_id")
    actions = testdata.actions(spark, sf)
    return as_text(skew.skew_join(actions, wanted, "session_id", "left_semi", share=0.001, salt_by=["event_id"]))


@query
def jon11_sketched_join(spark, sf):
    left = testdata.actions(spark, sf).select("event_id", "city_id", "page_id")
    return skew.skew_join(left, testdata.cities(spark, sf), "city_id", share=0.02, salt_by=["event_id"], sketch=True)


@query
def jon11_sketched_anti_join(spark, sf):
    wanted = known_sessions(spark, sf, MALE_20_45).select("session_id")
    actions = testdata.actions(spark, sf)
    return as_text(skew.skew_join(actions, wanted, "session_id", "left_anti", share=0.001, salt_by=["event_id"], sketch=True))


@query
def jon11_frequent_keys(spark, sf):
    return skew.frequent_keys(testdata.actions(spark, sf), ["page_id", "city_id"], 0.004)


# --- aggregations --------------------------------------------------------------------------------


@query
def agg2_observed_stats(spark, sf):
    observed, counts = sessions.observed_sessions(known_sessions(spark, sf))
    shared_table(observed, "observed")
    return sessions.stats_of_observed(spark, counts)


@query
def agg1_session_rollup(spark, sf):
    rolled = sessions.session_rollup(testdata.actions(spark, sf))
    return session_columns(rolled, "search_keywords", "click_category_ids")


@query
def agg2_session_stats(spark, sf):
    return sessions.session_stats(known_sessions(spark, sf))


@query
def agg3_category_kinds(spark, sf):
    return categories.category_kind_counts(testdata.actions(spark, sf))


@query
def agg5_session_category_clicks(spark, sf):
    return categories.session_category_clicks(testdata.actions(spark, sf))


@query
def agg6_hourly_sessions(spark, sf):
    return as_text(sampling.hourly_sessions(known_sessions(spark, sf)))


@query
def agg7_hop_counts(spark, sf):
    return page_flow.hop_counts(page_flow.flow_hops(steps(spark, sf), FLOW))


@query
def agg8_start_page_views(spark, sf):
    return page_flow.start_page_views(testdata.actions(spark, sf), FLOW)


@query
def agg9_area_product_counts(spark, sf):
    return area_counts(spark, sf)


@query
def agg10_salted_count(spark, sf):
    return skew.salted_count(testdata.actions(spark, sf), ["click_category_id"], salt_by=["event_id"])


@query
def agg11_distinct_users(spark, sf):
    return ads.users_to_blacklist(ads.user_ad_counts(ad_clicks(spark, sf)), THRESHOLD)


# --- windows, sort, sample, sets -----------------------------------------------------------------


@query
def win1_area_top_products(spark, sf):
    full = products.with_product(area_counts(spark, sf), testdata.products(spark, sf))
    level = products.area_level(F.col("area"), testdata.REGION_LEVELS)
    return products.top_products(full).drop("rank").withColumn("area_level", level)


@query
def win2_province_top_ads(spark, sf):
    return as_text(ads.province_top_ads(ads.ad_totals(ad_clicks(spark, sf))))


@query
def win3_top_sessions(spark, sf):
    return categories.top_sessions(top_category_clicks(spark, sf))


@query
def win4_bucketed_page_pairs(spark, sf):
    return page_flow.page_pairs(page_flow.page_steps(by_session(spark, sf), TIE_BREAK))


@query
def win4_page_pairs(spark, sf):
    return page_flow.page_pairs(steps(spark, sf))


@query
def srt1_top_categories(spark, sf):
    return top_categories(spark, sf)


@query
def smp1_session_sample(spark, sf):
    return session_columns(sampling.sample_sessions(stored_sessions(spark, sf), 1000))


@query
def smp1_session_sample_100(spark, sf):
    return session_columns(sampling.sample_sessions(stored_sessions(spark, sf)))


@query
def smp1_session_sample_of_a_day(spark, sf):
    day = stored_sessions(spark, sf).where(F.to_date("start_time") == F.lit("2024-01-10").cast("date"))
    return session_columns(sampling.sample_sessions(day))


@query
def smp1_session_sample_5000(spark, sf):
    return session_columns(sampling.sample_sessions(stored_sessions(spark, sf), 5000))


@query
def set1_category_universe(spark, sf):
    return categories.category_universe(testdata.actions(spark, sf))


# --- page flow -----------------------------------------------------------------------------------


@query
def fun1_flow_hops(spark, sf):
    return page_flow.flow_hops(steps(spark, sf), FLOW)


@query
def fun2_conversion_rates(spark, sf):
    return page_flow.conversion_rates(testdata.actions(spark, sf), FLOW, TIE_BREAK)


@query
def fun3_packed_rates(spark, sf):
    return page_conversion_row(testdata.actions(spark, sf), JobParams(target_page_flow=FLOW), TIE_BREAK)


# --- SQL functions -------------------------------------------------------------------------------


@query
def udf1_concat_long_string(spark, sf):
    register_functions(spark)
    cities = testdata.cities(spark, sf)
    return spark.sql("SELECT city_id, concat_long_string(city_id, city_name, ':') AS city_info FROM {c}", c=cities)


@query
def udf2_json_field(spark, sf):
    register_functions(spark)
    items = testdata.products(spark, sf)
    return spark.sql("SELECT product_id, json_field(extend_info, 'product_status') AS product_status FROM {p}", p=items)


@query
def udf2_variant_field(spark, sf):
    products = testdata.products(spark, sf)
    document = text.parsed_document(partly_unreadable("product_id", "extend_info"))
    return products.select("product_id", text.variant_field(document, "$.product_status", "int").alias("product_status"))


@query
def udf3_random_prefix(spark, sf):
    """Random values cannot be compared, so the prefix is checked and the rest kept."""
    register_functions(spark)
    prefixed = spark.sql("SELECT random_prefix(session_id, 8) AS value FROM {a}", a=testdata.actions(spark, sf))
    return prefixed.select(
        F.regexp_extract("value", "^[0-9]+_(.*)$", 1).alias("session_id"),
        F.regexp_extract("value", "^([0-9]+)_", 1).try_cast("int").between(0, 7).alias("prefix_in_range"),
    )


@query
def udf3_random_prefix_spread(spark, sf):
    """All eight prefixes occur."""
    register_functions(spark)
    prefix = spark.sql("SELECT random_prefix(session_id, 8) AS value FROM {a}", a=testdata.actions(spark, sf))
    return prefix.agg(F.countDistinct(F.substring_index("value", "_", 1)).alias("prefixes"))


@query
def udf4_remove_random_prefix(spark, sf):
    register_functions(spark)
    return spark.sql(
        "SELECT remove_random_prefix(random_prefix(session_id, 8)) AS session_id FROM {a}",
        a=testdata.actions(spark, sf),
    )


@query
def udf5_group_concat_distinct(spark, sf):
    names = text.group_concat_distinct(F.col("city_name"))
    return clicks_with_city(spark, sf).groupBy("area").agg(names.alias("city_names"))


# --- streams -------------------------------------------------------------------------------------


@query
def str1_clean_clicks(spark, sf):
    return as_text(spark.read.parquet(filtered_job(spark, sf).clean_log).drop("batch_id"))


@query
def str2_user_ad_counts(spark, sf):
    return as_text(filtered_job(spark, sf).user_clicks.read(spark))


@query
def str3_dynamic_blacklist(spark, sf):
    return filtered_job(spark, sf).blacklisted(spark)


@query
def str3_threshold_over_batches(spark, sf):
    return job_in_two_runs(spark, sf).blacklisted(spark)


@query
def str4_running_totals(spark, sf):
    return as_text(totalled_job(spark, sf).stat.read(spark))


@query
def str5_province_top_ads(spark, sf):
    return as_text(totalled_job(spark, sf).province_top.read(spark))


@query
def str6_click_trend(spark, sf):
    return as_text(trend_job(spark, sf).trend.read(spark))


@query
def str6_trailing_hour(spark, sf):
    return as_text(ads.trailing_minutes(ads.minute_clicks(ad_clicks(spark, sf))))


@query
def str7_restart(spark, sf):
    """Two runs over one checkpoint: the second finds nothing left to count."""
    job = ad_job(spark)
    for _ in range(2):
        job.filter_clicks(testdata.ad_log_stream(spark, sf)).awaitTermination()
        job.running_totals(job.clean_clicks(spark)).awaitTermination()
    return as_text(job.stat.read(spark))


@query
def str2_counts_over_batches(spark, sf):
    return as_text(job_in_two_runs(spark, sf).user_clicks.read(spark))


@query
def str5_top_ads_over_batches(spark, sf):
    return as_text(job_in_two_runs(spark, sf).province_top.read(spark))


@query
def str6_trend_over_batches(spark, sf):
    return as_text(job_in_two_runs(spark, sf).trend.read(spark))


@query
def str6_sliding_clicks(spark, sf):
    return as_text(ads.sliding_clicks(ad_clicks(spark, sf), "60 minutes", "10 minutes"))


@query
def str4_totals_by_state(spark, sf):
    """Three micro-batches, with a restart before the last."""
    job, folder, lines = ad_job(spark), new_folder(spark, "ad-lines"), testdata.ad_log(spark, sf)
    part = F.pmod(F.split("value", " ")[3].cast("bigint"), F.lit(3))
    for parts in ((0, 1), (2,)):
        for k in parts:
            lines.where(part == k).coalesce(1).write.mode("append").text(folder)
        clicks = ads.parse_ad_log(file_lines(spark, folder, 1))
        job.totals_by_state(clicks).awaitTermination()
    return as_text(job.stat.read(spark))


@query
def str6_sliding_stream(spark, sf):
    """Two micro-batches; the second brings late clicks, some of them too late, and completes more windows."""
    job, folder = dataclasses.replace(ad_job(spark), lateness="2 days"), new_folder(spark, "ad-lines")
    lines, minute = testdata.ad_log(spark, sf), F.pmod(F.floor(F.split("value", " ")[0].cast("bigint") / 60_000), F.lit(60))
    day = F.timestamp_millis(F.split("value", " ")[0].cast("bigint")).cast("date")
    late = (day == F.lit("2024-01-15").cast("date")) & (minute >= 30) | (day <= F.lit("2024-01-05").cast("date")) & (minute < 10)
    first = (day < F.lit("2024-01-16").cast("date")) & ~late
    for part in (first, ~first):
        lines.where(part).coalesce(1).write.mode("append").text(folder)
        job.sliding_clicks(file_lines(spark, folder), "60 minutes", "10 minutes").awaitTermination()
    return as_text(spark.read.parquet(job.sliding_log))


@query
def str7_restart_with_new_clicks(spark, sf):
    """The second run finds clicks that came after the first; users barred by the first stay out."""
    return as_text(job_in_two_runs(spark, sf).stat.read(spark))


# --- whole jobs ----------------------------------------------------------------------------------


@query
def job_area_top_products(spark, sf):
    return area_top_products(
        testdata.actions(spark, sf),
        testdata.cities(spark, sf),
        testdata.products(spark, sf),
        levels=testdata.REGION_LEVELS,
    )


@query
def job_session_stats(spark, sf):
    return analysis(spark, sf, FILTER).stats


@query
def job_session_sample(spark, sf):
    return as_text(analysis(spark, sf, sample_size=1000).sample)


@query
def job_top_categories(spark, sf):
    return analysis(spark, sf).top_categories


@query
def job_top_sessions(spark, sf):
    return analysis(spark, sf).top_sessions


@query
def job_area_products_in_sql(spark, sf):
    register_table_functions(spark, testdata.actions(spark, sf), testdata.cities(spark, sf), testdata.products(spark, sf))
    return spark.sql("SELECT * FROM area_top_products(DATE '2024-01-05', DATE '2024-01-20', 3)")


@query
def job_page_conversion_in_sql(spark, sf):
    register_table_functions(spark, testdata.actions(spark, sf), testdata.cities(spark, sf), testdata.products(spark, sf))
    flow = ",".join(map(str, FLOW))
    return spark.sql(f"SELECT * FROM page_conversion('{flow}', DATE '2024-01-01', DATE '2024-01-30')")


@query
def job_page_conversion(spark, sf):
    return page_conversion(testdata.actions(spark, sf), JobParams(target_page_flow=FLOW), TIE_BREAK)
