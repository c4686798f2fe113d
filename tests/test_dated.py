import pytest
from pyspark.sql import functions as F

from clickloom.session import new_folder
from clickloom.sinks import dated
from clickloom.sinks.append import read_results, write_task
from clickloom.sinks.dated import AppendedTable, DatedTable, glob, publish_batch

SCHEMA = "date date, k bigint, v bigint"


def table(spark, **settings):
    return DatedTable(new_folder(spark, "table"), SCHEMA, ["date", "k"], **settings)


def rows(spark, *data):
    return spark.createDataFrame(list(data), "day string, k bigint, v bigint").select(
        F.concat(F.lit("2024-01-"), "day").cast("date").alias("date"), "k", "v"
    )


def content(df):
    return sorted((str(r.date)[8:], r.k, r.v) for r in df.collect())


def test_tasks_keep_each_others_rows_and_replace_their_own(spark, tmp_path):
    path = str(tmp_path / "out")

    def of(*data):
        return spark.createDataFrame(list(data), "g string, k bigint, v bigint")

    write_task(of(("a", 1, 1)), path, 4)
    for _ in range(2):
        write_task(of(("b", 1, 1)), path, 5)
    assert sorted(map(tuple, read_results(spark, path).collect())) == [(4, "a", 1, 1), (5, "b", 1, 1)]
    write_task(of(("a", 1, 1)).where("false"), path, 4)
    assert sorted(map(tuple, read_results(spark, path).collect())) == [(5, "b", 1, 1)]


def test_latest_row_wins(spark):
    t = table(spark)
    assert t.read(spark).count() == 0
    t.update(rows(spark, ("01", 1, 10), ("01", 2, 20), ("02", 1, 1)), 0)
    t.update(rows(spark, ("01", 2, 21), ("03", 2, 5)), 1)
    assert content(t.read(spark)) == [("01", 1, 10), ("01", 2, 21), ("02", 1, 1), ("03", 2, 5)]
    assert content(t.read(spark, 0)) == [("01", 1, 10), ("01", 2, 20), ("02", 1, 1)]
    # A batch writes the dates it touches whole, and no other.
    assert content(t.batch(spark, 1)) == [("01", 1, 10), ("01", 2, 21), ("03", 2, 5)]
    assert t.read(spark).columns == ["date", "k", "v"]


def test_replayed_batch_adds_nothing(spark):
    t = table(spark, adds="v")
    for batch in (0, 1, 1, 1):
        t.update(rows(spark, ("01", 1, 10)), batch)
    assert content(t.read(spark)) == [("01", 1, 20)]


def test_batch_that_failed_between_two_dates_is_made_whole_by_its_replay(spark):
    t, data = table(spark, adds="v"), (("01", 1, 10), ("02", 1, 10))
    t.update(rows(spark, *data), 0)
    t.update(rows(spark, *data), 1)
    dated.delete_folder(spark, f"{t.path}/date=2024-01-02/batch_id=1")
    assert content(t.read(spark)) == [("01", 1, 20), ("02", 1, 10)]
    t.update(rows(spark, *data), 1)
    assert content(t.read(spark)) == [("01", 1, 20), ("02", 1, 20)]


def test_replaced_dates_lose_their_other_rows(spark):
    t = table(spark)
    t.replace(rows(spark, ("01", 1, 1), ("01", 2, 1), ("02", 1, 1)), 0)
    t.replace(rows(spark, ("01", 3, 2)), 1)
    assert content(t.read(spark)) == [("01", 3, 2), ("02", 1, 1)]


def test_dates_keep_a_bounded_number_of_versions(spark):
    t = table(spark, adds="v")
    for batch in range(7):
        t.update(rows(spark, ("01", batch % 2, 1), ("02" if batch < 2 else "03", 1, 1)), batch)
    assert content(t.read(spark)) == [("01", 0, 4), ("01", 1, 3), ("02", 1, 2), ("03", 1, 5)]
    versions = {date: sorted(n for d, n in t._versions(spark) if d == date) for date, _ in t._versions(spark)}
    assert versions == {"2024-01-01": [4, 5, 6], "2024-01-02": [0, 1], "2024-01-03": [4, 5, 6]}


@pytest.mark.parametrize("most", [1, 400])
def test_more_dates_than_are_named(spark, monkeypatch, most):
    monkeypatch.setattr(dated, "MOST_DATES", most)
    t = table(spark, adds="v")
    for batch in range(2):
        t.update(rows(spark, ("01", 1, 1), ("02", 1, 1), ("03", 1, 1)), batch)
    changed = rows(spark, ("01", 7, 1), ("02", 7, 1))
    t.update(changed, 2)
    assert content(t.read(spark)) == [("01", 1, 2), ("01", 7, 1), ("02", 1, 2), ("02", 7, 1), ("03", 1, 2)]
    assert content(t.batch(spark, 2)) == content(t.touched(changed, 2)) == content(t.read(spark).where("date < '2024-01-03'"))


def test_empty_batches_write_nothing(spark):
    t = table(spark)
    t.update(rows(spark).where("false"), 0)
    assert t.read(spark).count() == 0 and t._versions(spark) == [] and t.batch(spark, 0).count() == 0


def test_appended_rows_appear_once(spark):
    t = AppendedTable(new_folder(spark, "list"), "k bigint")
    assert t.read(spark).count() == 0
    for batch, keys in ((0, (1, 2)), (1, (2, 3)), (1, (2, 3)), (2, ())):
        t.append(spark.createDataFrame([(k,) for k in keys], "k bigint"), batch)
    assert sorted(r.k for r in t.read(spark).collect()) == [1, 2, 3]
    assert sorted(r.k for r in t.read(spark, 0).collect()) == [1, 2]


def test_published_batch_appears_once(spark):
    path = new_folder(spark, "log")
    assert content(publish_batch(rows(spark, ("01", 1, 1)), path, 3)) == [("01", 1, 1)]
    files = glob(spark, f"{path}/batch_id=3/*")
    assert content(publish_batch(rows(spark, ("09", 1, 1)), path, 3)) == [("01", 1, 1)]
    assert files == glob(spark, f"{path}/batch_id=3/*") and spark.read.parquet(path).count() == 1
    assert publish_batch(rows(spark).where("false"), path, 4).count() == 0
