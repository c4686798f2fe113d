"""Plans and edge cases of bucketed actions, Bloom filters, map joins, sketches, observed counts, variants and table functions."""

import random
import subprocess
import sys
import time
import uuid
from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pyspark
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from clickloom.functions import text
from clickloom.functions.sql import register_table_functions
from clickloom.operators import ads, page_flow, sessions, skew
from clickloom.plans.session_analysis import SessionAnalysis
from clickloom.session import STATE_STORE, new_folder, shared_dir, shared_table
from clickloom.sources import testdata
from clickloom.sources.ad_log import file_lines
from clickloom.sources.bucketed import write_by_session
from clickloom.sources.tasks import parse_task_params, parse_task_variants
from clickloom.streaming.ad_clicks import AdClickJob
from clickloom.streaming.state import running_total, totals_by_state

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def content(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def by_session(spark):
    return write_by_session(testdata.actions(spark, SF), f"t_{uuid.uuid4().hex}", new_folder(spark, "by-session"), 4)


def test_session_work_over_bucketed_actions_shuffles_nothing(spark, by_session, shuffle_only):
    shuffle_only()
    plain = testdata.actions(spark, SF)
    wanted = sessions.session_measures(by_session).where("step_length > 1").select("session_id")
    other = sessions.session_measures(plain).where("step_length > 1").select("session_id")
    for mine, theirs in (
        (sessions.session_rollup(by_session), sessions.session_rollup(plain)),
        (by_session.join(wanted, "session_id", "left_semi"), plain.join(other, "session_id", "left_semi")),
    ):
        assert "hashpartitioning(session_id" in plan(theirs) and "Exchange" not in plan(mine)
        assert content(mine) == content(theirs.select(mine.columns))
    steps = page_flow.page_steps(by_session, ("event_id",))
    assert "hashpartitioning(session_id" not in plan(steps)
    assert content(steps) == content(page_flow.page_steps(plain, ("event_id",)))


def test_a_bloom_filter_cuts_the_actions_below_the_shuffle(spark, shuffle_only):
    shuffle_only()
    actions = shared_table(testdata.actions(spark, SF), "actions")
    known = shared_table(sessions.with_user(sessions.session_measures(actions), testdata.users(spark, SF)), "known")
    wanted = F.col("age").between(20, 30) & (F.col("sex") == "male")
    threshold = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    rows, before = [], spark.conf.get(threshold)
    try:
        for size in ("0", "1GB"):
            spark.conf.set(threshold, size)
            detail = sessions.detail_of_matching(actions, known, wanted)
            assert ("might_contain" in plan(detail)) == (size == "0")
            rows.append(content(detail))
    finally:
        spark.conf.set(threshold, before)
    assert rows[0] == rows[1] and rows[0]


def test_map_join_ships_what_is_small_enough_only(spark, shuffle_only):
    shuffle_only()
    clicks, cities = spark.range(100).select((F.col("id") % 7).alias("city_id"), "id"), shared_table(testdata.cities(spark, SF), "cities")
    joined = skew.map_join(clicks, cities, "city_id", "left")
    assert "BroadcastHashJoin" in plan(joined) and "hashpartitioning" not in plan(joined)
    assert content(joined) == content(clicks.join(cities, "city_id", "left"))
    with pytest.raises(ValueError, match="estimated at"):
        skew.map_join(clicks, cities, "city_id", most_bytes=100)


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 7 holds a third of the rows; some keys are NULL."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400)
    return spark.range(3000).select(key.alias("k"), (F.col("id") % 5).alias("v"), F.col("id").alias("row_id"))


def test_frequent_keys_are_the_hot_keys(spark, skewed):
    for keys, share in ((["k"], 0.1), (["k"], 0.002), (["v"], 0.19), (["k", "v"], 0.05)):
        assert content(skew.frequent_keys(skewed, keys, share)) == content(skew.hot_keys(skewed, keys, share))
    assert skew.frequent_keys(skewed.where("false"), ["k"]).count() == 0
    assert skew.frequent_keys(skewed.where("k IS NULL"), ["k"]).count() == 0


def test_frequent_keys_shuffle_no_rows_by_key(skewed, monkeypatch):
    stored = []
    monkeypatch.setattr(skew, "shared_table", lambda df, name: stored.append((name, plan(df))) or shared_table(df, name))
    skew.frequent_keys(skewed, ["k"], 0.1)
    counted = dict(stored)["candidate-counts"]
    assert "BroadcastHashJoin" in counted and "hashpartitioning(k" not in counted


@pytest.mark.parametrize("how", skew.LEFT_DRIVEN_JOINS)
def test_sketched_join_equals_join(spark, skewed, how):
    right = spark.range(0, 300, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    joined = skew.skew_join(skewed, right, "k", how, share=0.1, sketch=True)
    assert content(joined) == content(skewed.join(right, "k", how).select(joined.columns))


def test_statistics_are_counted_by_the_write(spark):
    job = SessionAnalysis(testdata.actions(spark, SF), testdata.users(spark, SF))
    stats = job.stats
    # A row of counts, not a scan of the stored sessions.
    assert "parquet" not in plan(stats).lower() and content(stats) == content(sessions.session_stats(job.sessions))
    assert job.sessions.count() == stats.first().session_count == job.stats.first().session_count
    empty = SessionAnalysis(testdata.actions(spark, SF).where("false"), testdata.users(spark, SF)).stats.first()
    assert empty.session_count == 0 and empty.visit_length_1s_3s_ratio is None


def test_a_sample_alone_looks_for_no_top_sessions(spark):
    job = SessionAnalysis(testdata.actions(spark, SF), testdata.users(spark, SF), sample_size=20)
    sample = content(job.sample)
    assert "top_sessions" not in job.__dict__ and "facts" not in job.__dict__
    both = SessionAnalysis(testdata.actions(spark, SF), testdata.users(spark, SF), sample_size=20)
    assert both.top_session_detail.count() and content(both.sample) == sample and content(both.sample_detail) == content(job.sample_detail)


def test_documents_are_parsed_once_and_malformed_ones_are_null(spark):
    rows = [(1, '{"startDate":["a","b"],"sex":[""],"cities":null}'), (2, "{broken"), (3, None), (4, "[1]"), (5, '{"startDate":7,"endDate":["x"]}')]
    tasks = spark.createDataFrame(rows, "task_id long, task_param string")
    variants = parse_task_variants(tasks)
    assert logical(variants).count("parse_json(") + logical(variants).count("parseJson") <= 1
    got = {r.task_id: r for r in variants.collect()}
    assert got[1].start_date == "a" and got[1].sex is None and got[1].cities is None
    assert all(v is None for k in (2, 3, 4) for v in got[k][1:]) and (got[5].start_date, got[5].end_date) == (None, "x")
    whole = testdata.tasks(spark, SF)
    assert content(parse_task_variants(whole)) == content(parse_task_params(whole))
    field = text.variant_field(text.parsed_document(F.lit('{"a":{"b":["x","12"]}}')), "$.a.b[1]", "int")
    assert spark.range(1).select(field.alias("x")).first().x == 12


def test_table_functions_are_planned_as_their_text(spark):
    actions = testdata.actions(spark, SF)
    register_table_functions(spark, actions, testdata.cities(spark, SF), testdata.products(spark, SF))
    days = "DATE '2024-01-03', DATE '2024-01-09'"
    top = spark.sql(f"SELECT * FROM area_top_products({days}, 2)")
    assert "Python" not in plan(top) and top.groupBy("area").count().agg(F.max("count")).first()[0] <= 2
    rates = spark.sql(f"SELECT * FROM page_conversion('1,2,1,9', {days}) ORDER BY position")
    some = actions.where("date BETWEEN '2024-01-03' AND '2024-01-09'")
    assert content(rates) == content(page_flow.conversion_rates(some, [1, 2, 1, 9], ("event_id",)).select(rates.columns))
    assert spark.sql("SELECT * FROM page_conversion('1,2', DATE '1999-01-01', DATE '1999-01-02')").first().rate is None


# --- streams -------------------------------------------------------------------------------------

BASE = int(datetime(2024, 3, 1, 12, tzinfo=timezone.utc).timestamp() * 1000)


def line(seconds=0, user=1, ad=1, province="P", city="C"):
    return f"{BASE + int(seconds * 1000)} {province} {city} {user} {ad}"


@pytest.fixture
def feed(spark, tmp_path):
    folder, moment = tmp_path / "log", time.time() - 1000
    folder.mkdir()

    def add(*values):
        import os

        n = len(list(folder.iterdir()))
        path = folder / f"{n:04d}.txt"
        path.write_text("\n".join(values) + "\n")
        os.utime(path, (moment + n, moment + n))

    add.lines = lambda: file_lines(spark, str(folder), 1)
    return add


def job(spark, **settings):
    return AdClickJob(root=new_folder(spark, "job"), trigger={"availableNow": True}, **settings)


def totals(j, spark):
    return {(str(r.date), r.province, r.city, r.ad_id): r.click_count for r in j.stat.read(spark).collect()}


def test_totals_by_state_over_batches_and_restarts(spark, feed):
    rng, want, j = random.Random(4), Counter(), job(spark)
    for batch in range(3):
        data = [(rng.randrange(200_000), rng.randrange(5), f"P{rng.randrange(2)}") for _ in range(40)]
        feed(*[line(s, ad=a, province=p) for s, a, p in data])
        for s, a, p in data:
            want[str(datetime.fromtimestamp(BASE / 1000 + s, timezone.utc).date()), p, "C", a] += 1
        if batch:  # the first run takes two batches
            j.totals_by_state(ads.parse_ad_log(feed.lines())).awaitTermination()
            assert totals(j, spark) == want


def test_totals_by_state_in_a_session_with_another_state_store(spark, feed):
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        own, j = spark.conf.get(STATE_STORE), job(spark)
        for more in (line(0), line(1)):
            feed(more)
            j.totals_by_state(ads.parse_ad_log(feed.lines())).awaitTermination()
            assert spark.conf.get(STATE_STORE) == own
        assert totals(j, spark) == {("2024-03-01", "P", "C", 1): 2}
    finally:
        spark.conf.set(STATE_STORE, before)


def test_the_state_of_totals_can_be_read_where_the_library_is_not(tmp_path):
    (tmp_path / "processor").write_bytes(cloudpickle.dumps(running_total(idle=timedelta(hours=1))))
    # -I: neither PYTHONPATH nor the current folder; PySpark itself is there in any case.
    code = f"""import sys; sys.path.append({str(Path(pyspark.__file__).parents[1])!r})
import importlib.util, pickle
assert importlib.util.find_spec("clickloom") is None
print(type(pickle.load(open("processor", "rb"))).__name__)"""
    run = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert run.stdout.strip() == "RunningTotal", run.stderr


def test_idle_keys_leave_the_state(spark, feed):
    j = job(spark)
    # Ad 1 clicks, is quiet while ad 2 moves the time on by three hours, and clicks again.
    for seconds, ad in ((0, 1), (10, 1), (3 * 3600, 2), (3 * 3600 + 60, 2), (3 * 3600 + 120, 1)):
        feed(line(seconds, ad=ad))
    j.totals_by_state(ads.parse_ad_log(feed.lines()), idle=timedelta(hours=1)).awaitTermination()
    assert totals(j, spark) == {("2024-03-01", "P", "C", 1): 1, ("2024-03-01", "P", "C", 2): 2}
    lasting = job(spark)
    lasting.totals_by_state(ads.parse_ad_log(feed.lines()), idle=timedelta(hours=9)).awaitTermination()
    assert totals(lasting, spark) == {("2024-03-01", "P", "C", 1): 3, ("2024-03-01", "P", "C", 2): 2}


def test_time_to_live(spark, feed):
    feed(line(0), line(1))
    j = AdClickJob(root=new_folder(spark, "job"), trigger={"processingTime": "0 seconds"})
    query, until = j.totals_by_state(ads.parse_ad_log(feed.lines()), ttl=timedelta(days=1)), time.time() + 120
    try:
        while totals(j, spark) != {("2024-03-01", "P", "C", 1): 2}:
            assert time.time() < until and query.isActive
            time.sleep(0.5)
    finally:
        query.stop()


def test_wrong_settings(spark, feed):
    feed(line(0))
    with pytest.raises(ValueError, match="one of them"):
        totals_by_state(ads.parse_ad_log(feed.lines()), timedelta(1), timedelta(1))
    with pytest.raises(ValueError, match="processingTime"):
        job(spark).totals_by_state(ads.parse_ad_log(feed.lines()), ttl=timedelta(1))
    with pytest.raises(ValueError, match="lateness"):
        job(spark).sliding_clicks(feed.lines())


def test_sliding_stream_completes_windows_by_the_watermark(spark, feed):
    j = job(spark, lateness="30 seconds")
    # 12 is late, 0.5 too late, since the watermark stands at 10 by then; the last run finds nothing new.
    for new in ((line(0), line(5), line(40)), (line(12), line(0.5), line(100)), ()):
        if new:
            feed(*new)
        j.sliding_clicks(feed.lines(), "20 seconds", "10 seconds").awaitTermination()
    got = {
        (int(r.window_start.replace(tzinfo=timezone.utc).timestamp()) - BASE // 1000): r.click_count
        for r in spark.read.parquet(j.sliding_log).collect()
    }
    # Clicks at 0, 5, 12 and 40; windows end at 70 at the latest.
    assert got == {-10: 2, 0: 3, 10: 1, 30: 1, 40: 1}


def test_a_local_warehouse_is_refused_on_a_cluster():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Context:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Context()

        def __init__(self, **values):
            self.conf = Conf({k.replace("__", "."): v for k, v in values.items()})

    for place in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(spark__sql__warehouse__dir=place))
    assert shared_dir(Session(spark__sql__warehouse__dir="hdfs://x/w")) == "hdfs://x/w/_shared"
    assert shared_dir(Session(spark__checkpoint__dir="file:///shared/", spark__sql__warehouse__dir="/w")) == "file:///shared"
