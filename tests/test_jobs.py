import pytest

from clickloom import schemas
from clickloom.__main__ import ad_job, arguments
from clickloom.plans.jobs import run_page_job, run_product_job, run_session_job
from clickloom.session import clear_shared, new_folder, shared_table
from clickloom.plans.session_analysis import SessionAnalysis
from clickloom.sinks.append import folder_sink, read_results
from clickloom.sources import testdata

PARAMS = (
    '{"startDate":["2024-03-01"],"endDate":["2024-03-01"],"startAge":["20"],"endAge":["50"],'
    '"targetPageFlow":["1,2"]}'
)


@pytest.fixture
def tasks(spark):
    return spark.createDataFrame([(4, PARAMS)], "task_id bigint, task_param string")


@pytest.fixture
def actions(spark):
    """Textual, as delivered: unpadded hours, dates as text."""
    names = [part.split()[0] for part in schemas.ACTION_TEXT.split(", ")]
    rows = [
        {"session_id": "a", "page_id": 1, "action_time": "2024-03-01 9:00:00", "click_category_id": 3, "click_product_id": 1},
        {"session_id": "a", "page_id": 2, "action_time": "2024-03-01 9:00:05", "search_keyword": "k"},
        {"session_id": "b", "page_id": 1, "action_time": "2024-03-01 10:00:00", "click_category_id": 3, "click_product_id": 1},
        {"session_id": "z", "page_id": 1, "action_time": "2024-03-02 10:00:00", "date": "2024-03-02", "click_category_id": 8},
    ]
    defaults = {"date": "2024-03-01", "user_id": 1, "city_id": 1}
    return spark.createDataFrame([tuple({**defaults, **r}.get(n) for n in names) for r in rows], schemas.ACTION_TEXT)


def test_jobs_append_their_result_tables(spark, tmp_path, actions, tasks, make_users):
    users = make_users((1, 30, "dev", "rome", "male"))
    cities = spark.createDataFrame([(1, "Rome", "China East")], schemas.CITY_INFO)
    products = spark.createDataFrame([(1, "p", '{"product_status": 0}')], schemas.PRODUCT_INFO)
    sink = folder_sink(str(tmp_path))
    run_session_job(actions, users, tasks, 4, sink)
    run_page_job(actions, tasks, 4, sink)
    run_product_job(actions, cities, products, tasks, 4, sink)

    def rows(name):
        return sorted(tuple(r) for r in read_results(spark, f"{tmp_path}/{name}").collect())

    stat = read_results(spark, f"{tmp_path}/session_aggr_stat").first()
    assert (stat.task_id, stat.session_count, stat.visit_length_4s_6s_ratio, stat.step_length_1_3_ratio) == (4, 2, 0.5, 1.0)
    assert len(stat) == 17
    assert [r[:2] for r in rows("session_random_extract")] == [(4, "a"), (4, "b")]
    assert rows("top10_category") == [(4, 3, 2, 0, 0)]
    assert rows("top10_session") == [(4, 3, "a", 1), (4, 3, "b", 1)]
    detail = read_results(spark, f"{tmp_path}/session_detail")
    assert detail.count() == 6 and detail.columns == ["task_id", *schemas.SESSION_DETAIL_COLUMNS]
    assert rows("page_split_convert_rate") == [(4, "1_2=0.5")]
    assert rows("area_top3_product") == [(4, "China East", "A Level", 1, "1:Rome", 2, "p", "Self")]
    run_page_job(actions, tasks, 4, sink)
    assert len(rows("page_split_convert_rate")) == 1  # the task's rows are replaced


def scans_of(frame, folder):
    return sum(x.startswith(folder) for x in frame.inputFiles())


def test_session_results_read_stored_tables_only(spark, actions, make_users):
    stored = shared_table(actions, "actions")
    [source] = {x.rsplit("/", 1)[0] for x in stored.inputFiles()}
    result = SessionAnalysis(stored, make_users((1, 30, "dev", "rome", "male")))
    assert scans_of(result.activity, source) == 0 and scans_of(result._listed_actions, source) == 0
    for frame in (result.stats, result.sample, result.sample_detail, result.top_categories, result.top_sessions,
                  result.top_session_detail):
        assert scans_of(frame, source) == 0  # all read stored tables


def test_textual_dates_still_reach_the_file_scan(spark, actions, make_users):
    from clickloom.plans.session_analysis import SessionAnalysis
    from clickloom.sources.tasks import JobParams

    stored = shared_table(actions, "actions")
    result = SessionAnalysis(stored, make_users(), JobParams(start_date="2024-03-01", end_date="2024-03-01"))
    plan = result.selected.select("page_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-03-01)" in plan and "ReadSchema: struct<date:string,page_id:bigint>" in plan


def test_page_job_needs_a_flow(spark, actions):
    from clickloom.plans.page_conversion import page_conversion
    from clickloom.sources.tasks import JobParams

    with pytest.raises(ValueError):
        page_conversion(actions, JobParams(target_page_flow=(1,)))


def test_command_line():
    args = arguments(["session", "--task", "3", "--tables", "/in", "--out", "/out"])
    assert (args.job, args.task) == ("session", 3)
    ads = ["ads", "--root", "/r", "--files", "/f", "--threshold", "7", "--interval", "9 seconds"]
    job = ad_job(arguments(ads))
    assert (job.threshold, job.lateness, job.trigger) == (7, "1 day", {"processingTime": "9 seconds"})
    assert ad_job(arguments([*ads, "--lateness", "none", "--once"])).lateness is None
    page = ["page", "--task", "3", "--tables", "db", "--catalog", "--out", "/out", "--row-id", "event_id"]
    assert (arguments(page).catalog, arguments(page).row_id) == (True, "event_id")
    assert arguments(["ads", "--root", "/r", "--topics", "a,b", "--servers", "h:1"]).topics == "a,b"


def test_every_parsed_task_fits_the_job(spark):
    from clickloom.sources.tasks import load_job_params

    params = load_job_params(testdata.tasks(spark, "/root/testdata/sf0.001"), 6)
    assert params.sex == "male" and params.cities is None and params.target_page_flow == (1, 2, 3)


def test_clearing_the_shared_folder(spark):
    kept = shared_table(spark.range(3), "numbers")
    assert kept.count() == 3
    folder = new_folder(spark, "x").rsplit("/", 1)[0]
    clear_shared(spark)
    assert not spark._jvm.java.io.File(folder).exists()
