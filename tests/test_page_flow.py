import random
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickloom.operators import page_flow
from clickloom.plans.page_conversion import page_conversion, page_conversion_row
from clickloom.sources.tasks import JobParams

SCHEMA = "session_id string, page_id bigint, action_time timestamp, event_id bigint"


def frame(spark, rows):
    """rows: (session, page, second, id)"""
    df = spark.createDataFrame([(s, p, t, i) for s, p, t, i in rows], "session_id string, page_id bigint, t bigint, event_id bigint")
    return df.selectExpr("session_id", "page_id", "timestamp_seconds(1709251200 + t) AS action_time", "event_id")


def expected_pairs(rows):
    sessions = {}
    for s, p, t, i in rows:
        sessions.setdefault(s, []).append((t, i, p))
    pairs = Counter()
    for s, visits in sessions.items():
        pages = [p for _, _, p in sorted(visits)]
        pairs.update((s, a, b) for a, b in zip(pages, pages[1:]))
    return pairs


def got_pairs(df, **kwargs):
    steps = page_flow.page_steps(df, ["event_id"], **kwargs)
    return Counter(tuple(r) for r in page_flow.page_pairs(steps).collect())


def test_pairs_across_blocks(spark):
    rows = [("a", 1, 0, 0), ("a", 2, 599, 1), ("a", 3, 600, 2), ("a", 4, 5000, 3), ("a", 5, 5000, 4), ("b", 1, 10, 5)]
    assert got_pairs(frame(spark, rows)) == expected_pairs(rows)


def test_one_session_with_a_third_of_all_rows(spark):
    rng = random.Random(1)
    rows = [("hot", rng.randrange(6), rng.randrange(30_000), i) for i in range(1000)]
    rows += [(f"s{i % 400}", rng.randrange(6), rng.randrange(3000), i + 1000) for i in range(2000)]
    df = frame(spark, rows)
    pairs = expected_pairs(rows)
    assert got_pairs(df) == pairs
    flow = [1, 2, 3, 1, 2]
    rates = page_flow.conversion_rates(df, flow, ["event_id"]).orderBy("position").collect()
    hits = Counter()
    for (_, a, b), n in pairs.items():
        hits[f"{a}_{b}"] += n
    assert [r.hop_count for r in rates] == [hits["1_2"], hits["2_3"], hits["3_1"], hits["1_2"]]
    assert rates[0].base_count == sum(r[1] == 1 for r in rows)
    assert [r.base_count for r in rates[1:]] == [r.hop_count for r in rates[:-1]]
    counted = {r.hop: r.hop_count for r in page_flow.hop_counts(
        page_flow.flow_hops(page_flow.page_steps(df, ["event_id"]), flow)).collect()}
    assert counted == {h: hits[h] for h in ("1_2", "2_3", "3_1")}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3), st.integers(0, 40)), max_size=25), st.integers(1, 20))
def test_any_block_length_gives_the_same_pairs(spark, visits, block):
    rows = [(s, p, t, i) for i, (s, p, t) in enumerate(visits)]
    if rows:
        assert got_pairs(frame(spark, rows), block_seconds=block) == expected_pairs(rows)


def test_missing_hop_and_empty_base(spark):
    df = frame(spark, [("a", 1, 0, 0), ("a", 3, 1, 1)])
    rows = page_flow.conversion_rates(df, [1, 2, 3], ["event_id"]).orderBy("position").collect()
    assert [(r.hop, r.hop_count, r.base_count, r.rate) for r in rows] == [("1_2", 0, 1, 0.0), ("2_3", 0, 0, None)]
    nothing = page_flow.conversion_rates(df.where("false"), [1, 2], ["event_id"]).first()
    assert (nothing.hop_count, nothing.base_count, nothing.rate) == (0, 0, None)


def test_start_views_count_every_row(spark):
    df = frame(spark, [("a", 1, 0, 0), ("a", 1, 1, 1), ("b", 1, 0, 2), ("b", 2, 1, 3)])
    assert page_flow.start_page_views(df, [1, 2]).first()[0] == 3
    assert page_flow.conversion_rates(df, [1, 2], ["event_id"]).first().rate == 0.33


def test_packed_row(make_actions):
    actions = make_actions(
        {"page_id": 1, "action_time": "2024-03-01 1:00:00"},
        {"page_id": 2, "action_time": "2024-03-01 1:00:01"},
        {"page_id": 1, "action_time": "2024-03-01 1:30:00"},
        {"page_id": 2, "action_time": "2024-03-01 1:30:05"},
        {"page_id": 3, "action_time": "2024-03-01 1:30:06"},
        {"page_id": 9, "date": "2024-04-01"},
    )
    params = JobParams(start_date="2024-03-01", end_date="2024-03-31", target_page_flow=(1, 2, 3))
    assert page_conversion_row(actions, params).first().convert_rate == "1_2=1.0|2_3=0.5"
    assert page_conversion(actions, params).count() == 2
    again = JobParams(target_page_flow=(1, 2, 1, 2))
    assert page_conversion_row(actions, again).first().convert_rate == "2_1=0.5|1_2=2.0"


def test_hops_of_one_second_need_a_row_id(spark):
    df = frame(spark, [("a", 3, 0, 0), ("a", 2, 0, 1), ("a", 1, 0, 2), ("a", 2, 1, 3), ("a", 3, 2, 4)])
    known = page_flow.conversion_rates(df, [1, 2, 3], ["event_id"]).orderBy("position").collect()
    assert [r.hop_count for r in known] == [1, 1]
    unknown = page_flow.conversion_rates(df, [1, 2, 3]).orderBy("position").collect()
    assert [(r.hop_count, r.base_count) for r in unknown] == [(0, 1), (1, 0)]
    pairs = page_flow.page_pairs(page_flow.page_steps(df)).collect()
    assert [(r.prev_page_id, r.page_id) for r in pairs] == [(2, 3)]


def test_actions_without_session_make_no_hops(spark):
    df = frame(spark, [(None, 1, 0, 0), (None, 2, 1, 1), ("a", 1, 0, 2)])
    assert page_flow.page_steps(df, ["event_id"]).count() == 1
    assert page_flow.conversion_rates(df, [1, 2], ["event_id"]).first().hop_count == 0


def test_hot_sessions_are_spread_over_blocks(spark):
    plan = page_flow.flow_counts(frame(spark, [("a", 1, 0, 0)]), [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(session_id" in plan and "_block" in plan
