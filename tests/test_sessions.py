from pyspark.sql import functions as F

from clickloom.operators import categories, sampling, sessions
from clickloom.plans.session_analysis import SessionAnalysis
from clickloom.session import shared_table
from clickloom.sources.tasks import JobParams

RICH = [
    {"session_id": "a", "action_time": "2024-03-01 9:00:00", "search_keyword": "x"},
    {"session_id": "a", "action_time": "2024-03-01 9:00:02", "click_category_id": 11, "click_product_id": 5},
    {"session_id": "a", "action_time": "2024-03-01 9:00:03", "click_category_id": 1, "click_product_id": 5},
    {"session_id": "a", "action_time": "2024-03-01 9:00:01", "order_category_ids": "1,2", "order_product_ids": "7,8"},
    {"session_id": "b", "user_id": 2, "action_time": "2024-03-01 23:00:00", "pay_category_ids": "2,2,9"},
    {"session_id": "c", "user_id": 99, "action_time": "2024-03-01 9:00:00", "click_category_id": 1},
    {"session_id": "d", "user_id": 2, "action_time": "2024-03-01 9:30:00", "search_keyword": ""},
]
USERS = [(1, 30, "dev", "rome", "male"), (2, 40, "ops", "oslo", "female")]


def by_session(df):
    return {r.session_id: r for r in df.collect()}


def test_rollup(make_actions):
    rows = by_session(sessions.session_rollup(make_actions(*RICH)))
    assert (rows["a"].visit_length, rows["a"].step_length) == (3, 4)
    assert (rows["a"].search_keywords, rows["a"].click_category_ids) == ("x", "1,11")
    assert (rows["b"].visit_length, rows["b"].search_keywords, rows["b"].click_category_ids) == (0, "", "")
    assert rows["d"].search_keywords == ""


def test_measures_agree_with_the_rollup(make_actions):
    actions = make_actions(*RICH)
    rolled = by_session(sessions.session_rollup(actions))
    for session_id, row in by_session(sessions.session_measures(actions)).items():
        assert (row.visit_length, row.step_length) == (rolled[session_id].visit_length, rolled[session_id].step_length)


def test_filter_gives_the_same_sessions_from_lists_and_flags(make_actions, make_users):
    actions, users = make_actions(*RICH), make_users(*USERS)
    cases = [
        (JobParams(), {"a", "b", "d"}),
        (JobParams(start_age=35, end_age=45), {"b", "d"}),
        (JobParams(start_age=35), {"a", "b", "d"}),
        (JobParams(sex="male"), {"a"}),
        (JobParams(professionals=("ops", "x"), cities=("oslo",)), {"b", "d"}),
        (JobParams(keywords=("x", "z")), {"a"}),
        (JobParams(category_ids=(1,)), {"a"}),
        (JobParams(category_ids=(2,)), set()),
    ]
    for params, want in cases:
        flags = sessions.session_measures(actions, params.keywords, params.category_ids)
        for frame in (sessions.session_rollup(actions), flags):
            assert set(by_session(sessions.filter_sessions(frame, users, params))) == want


def test_profile_conditions_reach_the_user_scan(spark, make_actions, make_users):
    users = shared_table(make_users(*USERS), "users")
    kept = sessions.filter_sessions(sessions.session_measures(make_actions(*RICH)), users, JobParams(sex="male"))
    assert "EqualTo(sex,male)" in kept._jdf.queryExecution().executedPlan().toString()


def test_stats(spark, make_actions, make_users):
    kept = sessions.filter_sessions(sessions.session_measures(make_actions(*RICH)), make_users(*USERS), JobParams())
    row = sessions.session_stats(kept).first()
    # a lasts 3 s; b and d have length 0: counted, but in no bucket
    assert (row.session_count, row.visit_length_1s_3s_ratio, row.visit_length_30m_ratio) == (3, 0.33, 0.0)
    assert (row.step_length_1_3_ratio, row.step_length_4_6_ratio) == (0.67, 0.33)


def test_stats_of_nothing(make_actions, make_users):
    kept = sessions.filter_sessions(sessions.session_measures(make_actions()), make_users(*USERS), JobParams())
    row = sessions.session_stats(kept).first()
    assert row.session_count == 0 and row.visit_length_1s_3s_ratio is None


def test_category_counts(make_actions):
    actions = make_actions(*RICH)
    want = {1: (2, 1, 0), 2: (0, 1, 2), 9: (0, 0, 1), 11: (1, 0, 0)}
    got = {r.category_id: tuple(r)[1:] for r in categories.category_counts(actions).collect()}
    assert got == want
    from_facts = categories.category_counts_from_facts(categories.session_category_facts(actions))
    assert {r.category_id: tuple(r)[1:] for r in from_facts.collect()} == want
    ranked = [r.category_id for r in categories.top_categories(categories.category_counts(actions)).collect()]
    assert ranked == [1, 11, 2, 9]


def test_activity_holds_measures_and_facts(make_actions):
    actions = make_actions(*RICH, {"session_id": None, "click_category_id": 4})
    activity = categories.session_activity(actions, ["k"], [1])

    def same(one, other):
        columns = sorted(one.columns)
        assert columns == sorted(other.columns)
        assert sorted(map(repr, one.select(columns).collect())) == sorted(map(repr, other.select(columns).collect()))

    same(categories.measures_from_activity(activity), sessions.session_measures(actions, ["k"], [1]))
    same(categories.facts_from_activity(activity), categories.session_category_facts(actions))


def test_unreadable_ids_are_no_category(make_actions):
    counts = categories.category_counts(make_actions({"order_category_ids": "1,x,"}))
    assert [tuple(r) for r in counts.collect()] == [(1, 0, 1, 0)]


def test_popularity_ties_go_to_the_smaller_id(spark):
    counts = spark.createDataFrame(
        [(7, 5, 1, 1), (3, 5, 1, 1), (4, 5, 2, 0), (5, 5, 1, 2)],
        "category_id bigint, click_count bigint, order_count bigint, pay_count bigint",
    )
    assert [r.category_id for r in categories.top_categories(counts, 3).collect()] == [4, 5, 3]


def test_top_sessions_and_their_repeated_detail(make_actions):
    rows = [{"session_id": s, "click_category_id": c} for s, c in ("a1", "a1", "a2", "b1", "b2", "b2", "c1")]
    actions = make_actions(*[{**r, "click_category_id": int(r["click_category_id"])} for r in rows])
    best = categories.top_sessions(categories.session_category_clicks(actions), 2)
    assert {tuple(r) for r in best.collect()} == {(1, "a", 2), (1, "b", 1), (2, "b", 2), (2, "a", 1)}
    assert categories.top_session_detail(actions, best).count() == 2 * 6


def many_sessions(spark, hours: dict):
    rows = [
        (f"{day}-{hour}-{i}", f"{day} {hour:02d}:10:00")
        for (day, hour), count in hours.items()
        for i in range(count)
    ]
    df = spark.createDataFrame(rows, "session_id string, start string")
    return df.select("session_id", F.col("start").cast("timestamp").alias("start_time"))


def test_sample_follows_the_quotas(spark):
    hours = {("2024-03-01", 1): 300, ("2024-03-01", 2): 100, ("2024-03-02", 5): 10, ("2024-03-02", 6): 2}
    drawn = sampling.sample_sessions(many_sessions(spark, hours), 100)
    got = {(str(r.date), r.hour): r.session_count for r in sampling.hourly_sessions(drawn).collect()}
    # 50 a day: 3/4 and 1/4 of it; then 10/12 of 50 and 2/12 of 50, capped at what there is
    assert got == {("2024-03-01", 1): 37, ("2024-03-01", 2): 12, ("2024-03-02", 5): 10, ("2024-03-02", 6): 2}
    again = sampling.sample_sessions(many_sessions(spark, hours).repartition(7), 100)
    assert {r.session_id for r in again.collect()} == {r.session_id for r in drawn.collect()}
    other = sampling.sample_sessions(many_sessions(spark, hours), 100, seed="1")
    assert {r.session_id for r in other.collect()} != {r.session_id for r in drawn.collect()}


def test_quota_is_cut_in_floating_point(spark):
    """29 of 100 sessions times 100 is 28.999... and grants 28."""
    hours = {("2024-03-01", 1): 29, ("2024-03-01", 2): 71}
    quotas = sampling.hourly_quotas(sampling.hourly_sessions(many_sessions(spark, hours)), 100)
    assert {r.hour: r.quota for r in quotas.collect()} == {1: 28, 2: 71}


def test_sample_limits_hours_before_the_shuffle(spark):
    hours = {("2024-03-01", 1): 500}
    plan = sampling.sample_sessions(many_sessions(spark, hours), 100)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 100, Partial" in plan
    assert sampling.sample_sessions(many_sessions(spark, {}), 100).count() == 0


def test_whole_job(make_actions, make_users):
    actions, users = make_actions(*RICH), make_users(*USERS)
    result = SessionAnalysis(actions, users, JobParams(start_date="2024-03-01", end_date="2024-03-01"))
    assert result.stats.first().session_count == 3
    assert {tuple(r) for r in result.top_categories.collect()} == {(1, 1, 1, 0), (2, 0, 1, 2), (9, 0, 0, 1), (11, 1, 0, 0)}
    assert {tuple(r) for r in result.top_sessions.collect()} == {(1, "a", 1), (11, "a", 1)}
    assert result.top_session_detail.count() == 8
    sample = by_session(result.sample)
    assert set(sample) == {"a", "b", "d"} and sample["b"].search_keywords is None
    assert sample["a"].click_category_ids == "1,11"
    assert result.sample_detail.count() == 6
    nothing = SessionAnalysis(actions, users, JobParams(start_date="2025-01-01", end_date="2025-01-02"))
    assert nothing.stats.first().session_count == 0 and nothing.sample.count() == 0


def test_whole_job_with_too_many_sessions_to_broadcast(make_actions, make_users, shuffle_only):
    def reports():
        result = SessionAnalysis(make_actions(*RICH), make_users(*USERS), JobParams(start_age=20, end_age=50))
        return [sorted(map(repr, f.collect())) for f in (result.top_categories, result.top_sessions, result.top_session_detail)]

    want = reports()
    shuffle_only()
    assert reports() == want


def test_detail_by_broadcast_and_by_shuffle(make_actions, make_users, shuffle_only):
    actions, users = make_actions(*RICH), make_users(*USERS)
    kept = sessions.filter_sessions(sessions.session_measures(actions), users, JobParams())
    small = sessions.session_detail(actions, kept)
    shuffle_only()
    large = sessions.session_detail(actions, kept)
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    assert small.count() == 6 and small.columns == actions.columns
