from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.functions import text
from clickloom.functions.numbers import STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS, bucket, ratio
from clickloom.functions.predicates import any_listed, equal_to, in_range, one_of
from clickloom.functions.sql import register_functions


def column(spark, values, expression, kind="bigint"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_visit_buckets_at_every_edge(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801, 10**9]
    labels = [
        None, "1s_3s", "1s_3s", "4s_6s", "4s_6s", "7s_9s", "7s_9s", "10s_30s", "10s_30s", "30s_60s", "30s_60s",
        "1m_3m", "1m_3m", "3m_10m", "3m_10m", "10m_30m", "10m_30m", "30m", "30m",
    ]
    assert column(spark, lengths, bucket(F.col("v"), VISIT_LENGTH_BUCKETS)) == labels


def test_step_buckets_at_every_edge(spark):
    lengths = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    labels = ["1_3", "1_3", "4_6", "4_6", "7_9", "7_9", "10_30", "10_30", "30_60", "30_60", "60"]
    assert column(spark, lengths, bucket(F.col("v"), STEP_LENGTH_BUCKETS)) == labels


def test_ratio_rounds_half_up_without_floating_point(spark):
    pairs = [(29, 200, 0.15), (1, 3, 0.33), (2, 3, 0.67), (1, 200, 0.01), (0, 7, 0.0), (9, 4, 2.25), (3, 0, None)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint, want double")
    for row in df.withColumn("got", ratio(F.col("n"), F.col("d"))).collect():
        assert row.got == row.want


def test_in_range_needs_both_bounds(spark):
    values = [17, 18, 40, 41, None]
    assert column(spark, values, in_range(F.col("v"), 18, 40)) == [False, True, True, False, None]
    assert column(spark, values, in_range(F.col("v"), 18, None)) == [True] * 5
    assert column(spark, values, in_range(F.col("v"), None, 40)) == [True] * 5


def test_matching_values(spark):
    values = ["a", "b", "", None]
    assert column(spark, values, one_of(F.col("v"), ["a", "c"]), "string") == [True, False, False, None]
    assert column(spark, values, one_of(F.col("v"), None), "string") == [True] * 4
    assert column(spark, values, equal_to(F.col("v"), "b"), "string") == [False, True, False, None]
    lists = ["1,11", "11", "1", "", None]
    assert column(spark, lists, any_listed(F.col("v"), [1, 2]), "string") == [True, False, True, False, None]
    assert column(spark, lists, any_listed(F.col("v"), []), "string") == [False] * 5


def test_times_with_and_without_leading_zero(spark):
    parsed = column(spark, ["2024-03-01 7:05:09", "2024-03-01 07:05:09", "x"], text.parse_time(F.col("v")), "string")
    assert parsed[0] == parsed[1] and parsed[0].hour == 7 and parsed[2] is None
    assert column(spark, ["2024-03-01 7:05:09"], text.date_hour(text.parse_time(F.col("v"))), "string") == ["2024-03-01_07"]


def test_times_with_a_t_or_a_fraction(spark):
    given = ["2024-03-01T07:05:09", "2024-03-01 7:05:09.5", "2024-03-01T07:05:09.123456", "2024/03/01 07:05:09", None]
    parsed = column(spark, given, text.parse_time(F.col("v")), "string")
    assert [x and (x.hour, x.second, x.microsecond) for x in parsed] == [(7, 9, 0), (7, 9, 500000), (7, 9, 123456), None, None]


def test_string_helpers(spark):
    assert column(spark, [5, None], text.concat_long_string(F.col("v"), F.lit(None).cast("string"), ":")) == ["5:null", "null:null"]
    assert column(spark, ["12_a_b", "a_b", "x"], text.remove_random_prefix(F.col("v")), "string") == ["a_b", "a_b", "x"]
    assert column(spark, [",a,b,", "a"], text.trim_commas(F.col("v")), "string") == ["a,b", "a"]
    documents = ['{"a.b": 1, "c": "x"}', "{}", "broken", None]
    assert column(spark, documents, text.json_field(F.col("v"), "a.b"), "string") == ["1", None, None, None]
    prefixes = {v.split("_")[0] for v in column(spark, ["k"] * 200, text.random_prefix(F.col("v"), 4, 3), "string")}
    assert prefixes == {"0", "1", "2", "3"}


def test_distinct_concatenation_keeps_values_that_contain_each_other(spark):
    assert column(spark, ["11", "1", "11", None], text.group_concat_distinct(F.col("v")), "string") == ["1,11"]


def test_sql_functions_are_inlined(spark):
    register_functions(spark)
    row = spark.sql(
        """SELECT concat_long_string(7, 'x', ':') a, concat_long_string(NULL, 'x', ':') b,
                  json_field('{"k": "v"}', 'k') c, remove_random_prefix(random_prefix('p_q', 3)) d"""
    ).first()
    assert tuple(row) == ("7:x", "null:x", "v", "p_q")
    listed = spark.sql("SELECT listagg(DISTINCT c, ',') WITHIN GROUP (ORDER BY c) l FROM VALUES ('b'), ('a'), ('b') t(c)")
    assert listed.first().l == "a,b"


def test_grade_examples(spark):
    grades = spark.createDataFrame([("a", 85), ("b", 90), ("c", 60), ("d", 73)], "name string, grade int")
    grades.createOrReplaceTempView("grades")
    rows = spark.sql(
        """SELECT name, CASE WHEN grade >= 90 THEN 'A' WHEN grade >= 80 THEN 'B' WHEN grade >= 70 THEN 'C'
                  WHEN grade >= 60 THEN 'D' ELSE 'E' END AS level, if(grade >= 80, 'GOOD', 'BAD') AS mark
           FROM grades ORDER BY name"""
    ).collect()
    assert [r.level for r in rows] == ["B", "A", "D", "C"]
    assert [r.mark for r in rows] == ["GOOD", "GOOD", "BAD", "BAD"]


def test_row_number_example(spark):
    df = spark.createDataFrame([("class1", g) for g in (80, 75, 90, 60)], "class string, grade int")
    window = Window.partitionBy("class").orderBy(F.desc("grade"))
    ranked = {r.grade: r.rank for r in df.withColumn("rank", F.row_number().over(window)).collect()}
    assert ranked == {90: 1, 80: 2, 75: 3, 60: 4}
