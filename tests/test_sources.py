import pytest

from clickloom import schemas
from clickloom.session import build_session, shared_dir, shared_table
from clickloom.sources import tables
from clickloom.sources.tasks import load_job_params, parse_task_params


def pushed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_is_inclusive_for_text_and_date_columns(spark):
    rows = [("2024-03-01",), ("2024-03-02",), ("2024-03-03",)]
    textual = spark.createDataFrame(rows, "date string")
    for df in (textual, textual.selectExpr("cast(date AS date) AS date")):
        assert tables.scan_actions(df, "2024-03-02", "2024-03-03").count() == 2
        assert tables.scan_actions(df, None, "2024-03-01").count() == 1
        assert tables.scan_actions(df, None, None).count() == 3


def test_date_range_and_columns_reach_the_file_scan(spark, make_actions):
    stored = shared_table(make_actions({}, {"date": "2024-03-05"}), "actions")
    plan = pushed(tables.scan_actions(stored, "2024-03-02", "2024-03-09").select("session_id"))
    assert "GreaterThanOrEqual(date,2024-03-02)" in plan and "LessThanOrEqual(date,2024-03-09)" in plan
    assert "ReadSchema: struct<date:date,session_id:string>" in plan


def test_date_range_prunes_date_partitions(spark, make_actions, tmp_path):
    path = str(tmp_path / "actions")
    make_actions({}, {"date": "2024-03-05"}).write.partitionBy("date").parquet(path)
    scan = tables.scan_actions(tables.read_table(spark, path), "2024-03-02", "2024-03-09")
    assert scan.count() == 1
    assert "PartitionFilters: [isnotnull(date" in pushed(scan)


def test_unpadded_hours_are_read(make_actions):
    row = make_actions({"action_time": "2024-03-01 7:30:00"}).first()
    assert row.action_time.hour == 7


def test_delimited_text_with_null_markers(spark, tmp_path):
    path = tmp_path / "users"
    path.mkdir()
    (path / "part").write_text("1\x01u1\x01n1\x0133\x01job\x01null\x01male\n")
    users = tables.read_delimited(spark, str(path), schemas.USER_INFO)
    assert tuple(users.first()) == (1, "u1", "n1", 33, "job", None, "male")


def test_catalog_table(spark):
    spark.createDataFrame([("5", "c", "a")], "city_id string, city_name string, area string").createOrReplaceTempView("cities")
    cities = tables.city_info(tables.read_table(spark, "cities", "table"))
    assert cities.schema["city_id"].dataType.simpleString() == "bigint"
    assert cities.first().city_id == 5


TASK = (
    '{"startDate":["2024-03-01"],"endDate":["2024-03-02"],"startAge":["20"],"professionals":["a,b"],'
    '"sex":[],"cities":[""],"categoryIds":["3,17"],"targetPageFlow":["1,2,3"]}'
)


def tasks(spark):
    return spark.createDataFrame([(1, TASK), (2, "{}"), (3, "broken")], "task_id bigint, task_param string")


def test_parameters_are_first_elements(spark):
    params = load_job_params(tasks(spark), 1)
    assert (params.start_date, params.start_age, params.end_age) == ("2024-03-01", 20, None)
    assert params.professionals == ("a", "b") and params.category_ids == (3, 17)
    assert params.sex is None and params.cities is None and params.target_page_flow == (1, 2, 3)
    assert load_job_params(tasks(spark), 2).start_date is None
    assert parse_task_params(tasks(spark)).count() == 3


def test_unknown_task(spark):
    with pytest.raises(LookupError):
        load_job_params(tasks(spark), 9)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_settings_are_applied(spark):
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"


def test_unreadable_actions_are_found_and_become_null(spark):
    schema = "id int, date string, action_time string, order_category_ids string, pay_category_ids string"
    rows = [
        (1, "2024-03-01", "2024-03-01 9:00:00", "1,2", None),
        (2, "2024-03-01", "soon", "1,two", "3,"),
        (3, "first of March", None, None, "x"),
        (4, None, None, "", None),
    ]
    actions = spark.createDataFrame(rows, schema)
    found = {x.id: x.reasons for x in tables.unreadable_actions(actions).collect()}
    assert found == {2: "action_time,order_category_ids", 3: "date,pay_category_ids"}
    typed = {x.id: (x.date, x.action_time) for x in tables.typed_actions(actions).collect()}
    assert typed[3] == (None, None) and typed[2][1] is None and None not in typed[1]
    assert tables.unreadable_actions(tables.typed_actions(actions).limit(0)).count() == 0
