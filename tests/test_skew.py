import pytest
from pyspark.sql import functions as F

from clickloom.operators import ranking, skew
from clickloom.session import shared_table


@pytest.fixture(scope="module")
def left(spark):
    """Key 7 holds a third of the rows, many of them identical; some keys are NULL."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"),
        (F.col("id") % 5).alias("v"),
        F.col("id").alias("row_id"),
    )
    return df


@pytest.fixture(scope="module")
def right(spark):
    # key 7 twice: a join may multiply rows
    return spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).union(
        spark.createDataFrame([(7, 71)], "k bigint, w bigint")
    )


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(a.columns).collect()))


def test_hot_keys_are_few(left):
    assert [r.k for r in skew.hot_keys(left, ["k"], share=0.1).collect()] == [7]
    assert skew.hot_keys(left, ["k"], share=0.0001).count() <= 10_000
    assert [r.k for r in skew.hot_keys(left, ["k"], share=0.1, sample=0.5).collect()] == [7]
    assert skew.hot_keys(left.where("false"), ["k"]).count() == 0


@pytest.mark.parametrize("how", skew.LEFT_DRIVEN_JOINS)
@pytest.mark.parametrize("sample", [None, 0.3])
def test_skew_join_equals_join(left, right, how, sample):
    same(skew.skew_join(left, right, "k", how, share=0.1, sample=sample), left.join(right, "k", how))


def test_skew_join_on_two_columns(left):
    right = left.select("k", "v").distinct().withColumn("w", F.lit(1))
    same(skew.skew_join(left, right, ["k", "v"], share=0.02), left.join(right, ["k", "v"]))


def test_hot_key_is_spread(spark, left, right):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.skew_join(left, right, "k", share=0.1, salt_by=["row_id"], salts=16)
        parts = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
        plain = left.join(right, "k").where("k = 7").select(F.spark_partition_id().alias("p")).distinct()
        assert plain.count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unsupported_join_type(left, right):
    with pytest.raises(ValueError):
        skew.skew_join(left, right, "k", "full")


def test_map_join_needs_a_known_size_and_then_shuffles_nothing(left, right, shuffle_only):
    def plan(df):
        df.count()
        return df._jdf.queryExecution().executedPlan().toString()

    # Rows from Python have no known size; a stored table has.
    with pytest.raises(ValueError, match="estimated at"):
        skew.map_join(left, right, "k")
    want = left.join(right, "k").collect()
    shuffle_only()
    joined = skew.map_join(left, shared_table(right, "right"), "k")
    assert "BroadcastHashJoin" in plan(joined) and "SortMergeJoin" not in plan(joined)
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, want))


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_filter_by_keys(left, right, how, shuffle_only):
    same(skew.filter_by_keys(left, right, "k", how), left.join(right, "k", how))
    shuffle_only()
    same(skew.filter_by_keys(left, right, "k", how), left.join(right, "k", how))


def test_salted_count_equals_count(left):
    want = left.groupBy("k").agg(F.count("*").alias("row_count"))
    same(skew.salted_count(left, ["k"]), want)
    same(skew.salted_count(left, ["k"], salt_by=["row_id"]), want)


@pytest.mark.parametrize("n", [1, 3, 1500])
def test_top_n(left, n):
    order = [F.desc("v"), F.asc("row_id")]
    got = sorted((r.k is None, r.k, r.row_id) for r in ranking.top_n(left, ["k"], order, n).collect())
    groups = {}
    for r in left.collect():
        groups.setdefault(r.k, []).append((-r.v, r.row_id))
    want = sorted((k is None, k, i) for k, rows in groups.items() for _, i in sorted(rows)[:n])
    assert got == want


def test_top_n_limits_before_the_shuffle(left):
    plan = ranking.top_n(left, ["k"], [F.asc("row_id")], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1000, Partial" in plan
