"""SQL for DuckDB, one statement per query of `acceptance.queries`."""

from __future__ import annotations

VISIT = [
    ("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
    ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, None),
]
STEP = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60), ("60", 61, None)]

DAY = "strftime({}, '%Y-%m-%d')"
TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"

# --- derived tables, as common table expressions -------------------------------------------------

CTES = {
    "keyed": ([], """
        SELECT *, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""),
    "actions": (["keyed"], """
        SELECT cast(ts AS DATE) AS date, user_id,
               user_id || '_' || strftime(ts, '%Y%m%d') AS session_id,
               k % 10 AS page_id, date_trunc('second', ts) AS action_time,
               CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
               CASE WHEN event_type = 'click' THEN k END AS click_category_id,
               CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
               CASE WHEN event_type = 'signup' THEN k || ',' || (k * 7 % 100) END AS order_category_ids,
               CASE WHEN event_type = 'signup' THEN k || ',' || (k * 7 % 100) END AS order_product_ids,
               CASE WHEN event_type = 'purchase' THEN k || ',' || (k * 7 % 100) END AS pay_category_ids,
               CASE WHEN event_type = 'purchase' THEN k || ',' || (k * 7 % 100) END AS pay_product_ids,
               user_id % 25 AS city_id, event_id
        FROM keyed"""),
    "user_info": ([], """
        SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
               cast(18 + c_custkey % 50 AS INTEGER) AS age, c_mktsegment AS professional,
               'city' || c_nationkey AS city,
               CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
        FROM customer"""),
    "product_info": ([], """
        SELECT p_partkey AS product_id, p_name AS product_name,
               '{"product_status": ' || (p_partkey % 2) || '}' AS extend_info FROM part"""),
    "city_info": ([], """
        SELECT cast(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "sessions": (["actions"], """
        SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time,
               date_diff('second', min(action_time), max(action_time)) AS visit_length,
               count(*) AS step_length,
               coalesce(array_to_string(list_sort(list(DISTINCT search_keyword)
                   FILTER (WHERE search_keyword IS NOT NULL)), ','), '') AS search_keywords,
               coalesce(array_to_string(list_sort(list(DISTINCT click_category_id)
                   FILTER (WHERE click_category_id IS NOT NULL)), ','), '') AS click_category_ids
        FROM actions GROUP BY session_id"""),
    "user_sessions": (["sessions", "user_info"], """
        SELECT s.*, u.age, u.professional, u.city, u.sex FROM sessions s JOIN user_info u USING (user_id)"""),
    "entries": (["actions"], """
        SELECT session_id, click_category_id AS category_id, 'click' AS kind FROM actions
        WHERE click_category_id IS NOT NULL
        UNION ALL
        SELECT session_id, cast(unnest(string_split(order_category_ids, ',')) AS BIGINT), 'order' FROM actions
        WHERE order_category_ids IS NOT NULL
        UNION ALL
        SELECT session_id, cast(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 'pay' FROM actions
        WHERE pay_category_ids IS NOT NULL"""),
    "counts": (["entries"], """
        SELECT category_id, cast(sum(kind = 'click') AS BIGINT) AS click_count,
               cast(sum(kind = 'order') AS BIGINT) AS order_count, cast(sum(kind = 'pay') AS BIGINT) AS pay_count
        FROM entries GROUP BY category_id"""),
    "top_category": (["counts"], """
        SELECT * FROM counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10"""),
    "category_session": (["entries"], """
        SELECT category_id, session_id, count(*) AS click_count FROM entries WHERE kind = 'click'
        GROUP BY category_id, session_id"""),
    "top_session": (["category_session", "top_category"], """
        SELECT category_id, session_id, click_count FROM category_session
        WHERE category_id IN (SELECT category_id FROM top_category)
        QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) <= 10"""),
    "hours": (["user_sessions"], """
        SELECT cast(start_time AS DATE) AS date, cast(hour(start_time) AS INTEGER) AS hour,
               count(*) AS session_count
        FROM user_sessions GROUP BY ALL"""),
    "quotas": (["hours"], """
        SELECT date, hour, least(cast(floor(cast(session_count AS DOUBLE)
                 / cast(sum(session_count) OVER (PARTITION BY date) AS DOUBLE)
                 * cast({total} // (SELECT count(DISTINCT date) FROM hours) AS DOUBLE)) AS BIGINT),
               session_count) AS quota
        FROM hours"""),
    "sample": (["user_sessions", "quotas"], """
        SELECT r.* FROM (
            SELECT *, cast(start_time AS DATE) AS date, cast(hour(start_time) AS INTEGER) AS hour,
                   row_number() OVER (PARTITION BY cast(start_time AS DATE), hour(start_time)
                                      ORDER BY md5('0' || session_id), session_id) AS rn
            FROM user_sessions) r
        JOIN quotas q ON r.date = q.date AND r.hour = q.hour AND r.rn <= q.quota"""),
    "steps": (["actions"], """
        SELECT session_id, page_id,
               lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS prev_page_id
        FROM actions"""),
    "pairs": (["steps"], "SELECT * FROM steps WHERE prev_page_id IS NOT NULL"),
    "matched": (["pairs"], """
        SELECT session_id, prev_page_id || '_' || page_id AS hop FROM pairs
        WHERE prev_page_id || '_' || page_id IN ('1_2', '2_3', '3_4', '4_5')"""),
    "rates": (["matched", "actions"], """
        SELECT *, CASE WHEN base_count > 0
                  THEN cast((200 * hop_count + base_count) // (2 * base_count) AS DOUBLE) / 100.0 END AS rate
        FROM (SELECT position, hop, hop_count,
                     coalesce(lag(hop_count) OVER (ORDER BY position),
                              (SELECT count(*) FROM actions WHERE page_id = 1)) AS base_count
              FROM (SELECT p.position, p.hop, (SELECT count(*) FROM matched m WHERE m.hop = p.hop) AS hop_count
                    FROM (VALUES (1, '1_2'), (2, '2_3'), (3, '3_4'), (4, '4_5')) p(position, hop)))"""),
    "clicks_by_city": (["actions", "city_info"], """
        SELECT a.city_id, c.city_name, c.area, a.click_product_id AS product_id
        FROM actions a JOIN city_info c USING (city_id) WHERE a.click_product_id IS NOT NULL"""),
    "area_counts": (["clicks_by_city"], """
        SELECT area, product_id, count(*) AS click_count,
               array_to_string(list_sort(list(DISTINCT city_id || ':' || city_name)), ',') AS city_infos
        FROM clicks_by_city GROUP BY area, product_id"""),
    "area_full": (["area_counts", "product_info"], """
        SELECT c.*, p.product_name,
               CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0' THEN 'Self'
                    ELSE 'Third Party' END AS product_status
        FROM area_counts c JOIN product_info p USING (product_id)"""),
    "ad_clicks": (["keyed"], """
        SELECT make_timestamp_ms(epoch_us(ts) // 1000) AS click_time, cast(ts AS DATE) AS date,
               replace(r_name, ' ', '-') AS province, n_name AS city, user_id, k % 10 AS ad_id
        FROM keyed JOIN nation ON n_nationkey = user_id % 25 JOIN region ON n_regionkey = r_regionkey
        WHERE event_type = 'click'"""),
    "user_ad": (["ad_clicks"], """
        SELECT date, user_id, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY ALL"""),
    "seed": (["ad_clicks"], """
        SELECT DISTINCT user_id FROM ad_clicks WHERE date <= DATE '2024-01-10'
        GROUP BY date, user_id, ad_id HAVING count(*) >= 2"""),
    "clean": (["ad_clicks", "seed"], """
        SELECT * FROM ad_clicks WHERE user_id NOT IN (SELECT user_id FROM seed)"""),
    "clean_user_ad": (["clean"], """
        SELECT date, user_id, ad_id, count(*) AS click_count FROM clean GROUP BY ALL"""),
    "ad_stat": (["ad_clicks"], """
        SELECT date, province, city, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY ALL"""),
    "province_ads": (["ad_clicks"], """
        SELECT date, province, ad_id, count(*) AS click_count FROM ad_clicks GROUP BY date, province, ad_id
        QUALIFY row_number() OVER (PARTITION BY date, province ORDER BY count(*) DESC, ad_id) <= 3"""),
    "first_run": (["ad_clicks"], """
        SELECT * FROM ad_clicks WHERE minute(click_time) < 30"""),
    "barred_first": (["first_run"], """
        SELECT DISTINCT user_id FROM first_run GROUP BY date, user_id, ad_id HAVING count(*) >= 2"""),
    "both_runs": (["first_run", "barred_first"], """
        SELECT * FROM first_run
        UNION ALL
        SELECT * FROM ad_clicks
        WHERE minute(click_time) >= 30 AND user_id NOT IN (SELECT user_id FROM barred_first)"""),
    "user_ad_both": (["both_runs"], """
        SELECT date, user_id, ad_id, count(*) AS click_count FROM both_runs GROUP BY ALL"""),
    "minutes": (["ad_clicks"], """
        SELECT date_trunc('minute', click_time) AS minute_start, ad_id, count(*) AS click_count
        FROM ad_clicks GROUP BY ALL"""),
}


def _with(body: str, *names: str, **values) -> str:
    """`body` behind the common table expressions it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in ordered:
        text = CTES[name][1]
        for key, value in values.items():
            text = text.replace("{" + key + "}", str(value))
        parts.append(f"{name} AS ({text})")
    return "WITH " + ",\n".join(parts) + "\n" + body


def _stats(source: str) -> str:
    columns = ["count(*) AS session_count"]
    for measure, buckets in (("visit_length", VISIT), ("step_length", STEP)):
        for label, low, high in buckets:
            inside = f"{measure} >= {low}" + (f" AND {measure} <= {high}" if high else "")
            n = f"count(*) FILTER (WHERE {inside})"
            columns.append(
                f"CASE WHEN count(*) > 0 THEN cast((200 * {n} + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0 END"
                f" AS {measure}_{label}_ratio"
            )
    return f"SELECT {', '.join(columns)} FROM {source}"


ACTION_COLUMNS = (
    DAY.format("date") + " AS date, user_id, session_id, page_id, " + TIME.format("action_time")
    + " AS action_time, search_keyword, click_category_id, click_product_id, order_category_ids, "
    "order_product_ids, pay_category_ids, pay_product_ids, city_id, event_id"
)
DETAIL_COLUMNS = (
    "user_id, session_id, page_id, " + TIME.format("action_time") + " AS action_time, search_keyword, "
    "click_category_id, click_product_id, order_category_ids, order_product_ids, pay_category_ids, "
    "pay_product_ids"
)
SESSION_COLUMNS = (
    "session_id, user_id, " + TIME.format("start_time") + " AS start_time, visit_length, step_length"
)
FILTER = """age BETWEEN 20 AND 55 AND professional IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
    AND city IN ('city1', 'city2', 'city3', 'city5', 'city8', 'city13', 'city21') AND sex = 'male'
    AND list_has_any(string_split(search_keywords, ','), ['kw1', 'kw3', 'kw5', 'kw7'])
    AND list_has_any(string_split(click_category_ids, ','), {categories})"""
CATEGORY_FILTER = [str(i) for i in range(60)]
AREA_LEVEL = """CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A Level' WHEN area = 'ASIA' THEN 'B Level'
    WHEN area = 'EUROPE' THEN 'C Level' ELSE 'D Level' END"""
AD_TIME = "strftime(click_time, '%Y-%m-%d %H:%M:%S.%g')"
MINUTE = "strftime(minute_start, '%Y-%m-%d %H:%M')"


def statements() -> dict[str, str]:
    day = DAY.format("date") + " AS date"
    filtered = FILTER.format(categories=CATEGORY_FILTER)
    bucket = {
        name: "CASE " + " ".join(
            f"WHEN {measure} >= {low}" + (f" AND {measure} <= {high}" if high else "") + f" THEN '{label}'"
            for label, low, high in buckets
        ) + " END"
        for name, measure, buckets in (("visit", "visit_length", VISIT), ("step", "step_length", STEP))
    }
    area_top = f"""SELECT area, {AREA_LEVEL} AS area_level, product_id, city_infos, click_count, product_name,
        product_status FROM area_full
        QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) <= 3"""
    task = """SELECT c_custkey AS task_id, '2024-01-01' AS start_date, '2024-01-30' AS end_date,
        cast(13 + c_custkey % 50 AS VARCHAR) AS start_age, cast(23 + c_custkey % 50 AS VARCHAR) AS end_age,
        c_mktsegment || ',STUDENT' AS professionals, cast(NULL AS VARCHAR) AS cities,
        CASE WHEN c_custkey % 2 = 0 THEN 'male' END AS sex, cast(NULL AS VARCHAR) AS keywords,
        cast(NULL AS VARCHAR) AS category_ids, '1,2,3' AS target_page_flow FROM customer"""
    clicks = f"SELECT {AD_TIME} AS click_time, {day}, province, city, user_id, ad_id FROM "
    trend = f"""SELECT {DAY.format('minute_start')} AS date, strftime(minute_start, '%H') AS hour,
        strftime(minute_start, '%M') AS minute, ad_id, click_count FROM minutes"""
    stat = f"SELECT {day}, province, city, ad_id, click_count FROM ad_stat"
    counts = "SELECT category_id, click_count, order_count, pay_count FROM "
    return {
        # sources
        "src1_actions_by_date": _with(
            f"SELECT {ACTION_COLUMNS} FROM actions WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
            "actions"),
        "scl2_unreadable_actions": _with(
            """SELECT event_id, concat_ws(',', CASE WHEN event_id % 5 = 3 THEN 'action_time' END,
                      CASE WHEN event_id % 7 = 0 AND order_category_ids IS NOT NULL THEN 'order_category_ids' END,
                      CASE WHEN event_id % 7 = 0 AND pay_category_ids IS NOT NULL THEN 'pay_category_ids' END) AS reasons
               FROM actions
               WHERE event_id % 5 = 3
                  OR event_id % 7 = 0 AND (order_category_ids IS NOT NULL OR pay_category_ids IS NOT NULL)""",
            "actions"),
        "src2_user_info": _with("SELECT * FROM user_info", "user_info"),
        "src2_product_info": _with("SELECT * FROM product_info", "product_info"),
        "src3_city_info": _with("SELECT * FROM city_info", "city_info"),
        "src1_bucketed_rollup": _with(
            f"SELECT {SESSION_COLUMNS}, search_keywords, click_category_ids FROM sessions", "sessions"),
        "src4_task_params": task,
        "src4_task_variants": "SELECT task_id, " + ", ".join(
            f"CASE WHEN task_id % 7 <> 0 THEN {x} END AS {x}" for x in (
                "start_date", "end_date", "start_age", "end_age", "professionals", "cities", "sex", "keywords",
                "category_ids", "target_page_flow")) + f" FROM ({task})",
        "src5_ad_log_stream": _with(
            """SELECT epoch_ms(click_time) || ' ' || province || ' ' || city || ' ' || user_id || ' ' || ad_id
               AS value FROM ad_clicks""", "ad_clicks"),
        "src6_blacklist_snapshot": _with("SELECT user_id FROM seed", "seed"),
        # sinks
        "snk1_append": _with(
            f"""SELECT t.task_id, c.* FROM ({counts} top_category) c CROSS JOIN (VALUES (1), (2)) t(task_id)"""
            .replace("t.task_id", "cast(t.task_id AS BIGINT) AS task_id"), "top_category"),
        "snk2_upsert_replace": _with(stat, "ad_stat"),
        "snk3_upsert_add": _with(f"SELECT {day}, user_id, ad_id, click_count FROM user_ad", "user_ad"),
        "snk4_delete_insert": _with(f"SELECT {day}, province, ad_id, click_count FROM province_ads", "province_ads"),
        "snk5_blacklist_append": _with(
            "SELECT DISTINCT user_id FROM user_ad WHERE click_count >= 2", "user_ad"),
        # filters and projections
        "flt1_age_range": _with("SELECT user_id, age FROM user_info WHERE age BETWEEN 25 AND 40", "user_info"),
        "flt2_any_match": _with(
            f"""SELECT session_id, search_keywords FROM sessions
                WHERE list_has_any(string_split(search_keywords, ','), ['kw1', 'kw4'])""", "sessions"),
        "flt3_sex_equal": _with("SELECT user_id, sex FROM user_info WHERE sex = 'female'", "user_info"),
        "flt4_session_filter": _with(
            f"SELECT {SESSION_COLUMNS}, age, professional, city, sex FROM user_sessions WHERE {filtered}",
            "user_sessions"),
        "flt5_not_null": _with(
            "SELECT city_id, click_product_id AS product_id FROM actions WHERE click_product_id IS NOT NULL",
            "actions"),
        "prj1_area_level": _with(f"SELECT city_id, area, {AREA_LEVEL} AS area_level FROM city_info", "city_info"),
        "prj2_product_status": _with(
            """SELECT product_id, CASE WHEN json_extract_string(extend_info, '$.product_status') = '0'
               THEN 'Self' ELSE 'Third Party' END AS product_status FROM product_info""", "product_info"),
        "prj3_buckets": _with(
            f"""SELECT session_id, visit_length, {bucket['visit']} AS visit_bucket, step_length,
                {bucket['step']} AS step_bucket FROM sessions""", "sessions"),
        "prj4_parse_ad_log": _with(clicks + "ad_clicks", "ad_clicks"),
        # joins
        "jon1_session_user": _with(
            f"SELECT {SESSION_COLUMNS}, age, professional, city, sex FROM user_sessions", "user_sessions"),
        "jon2_session_detail": _with(
            f"""SELECT {ACTION_COLUMNS} FROM actions
                WHERE session_id IN (SELECT session_id FROM user_sessions WHERE sex = 'male' AND age BETWEEN 20 AND 45)""",
            "actions", "user_sessions"),
        "jon2_bucketed_session_detail": _with(
            f"""SELECT {ACTION_COLUMNS} FROM actions
                WHERE session_id IN (SELECT session_id FROM user_sessions WHERE sex = 'male' AND age BETWEEN 20 AND 45)""",
            "actions", "user_sessions"),
        "jon2_detail_of_matching": _with(
            f"""SELECT {ACTION_COLUMNS} FROM actions
                WHERE session_id IN (SELECT session_id FROM user_sessions WHERE sex = 'male' AND age BETWEEN 20 AND 45)""",
            "actions", "user_sessions"),
        "jon3_sample_detail": _with(
            f"SELECT {DETAIL_COLUMNS} FROM actions WHERE session_id IN (SELECT session_id FROM sample)",
            "actions", "sample", total=1000),
        "jon4_category_counts": _with(
            """SELECT u.category_id, coalesce(c.n, 0) AS click_count, coalesce(o.n, 0) AS order_count,
                      coalesce(p.n, 0) AS pay_count
               FROM (SELECT DISTINCT category_id FROM entries) u
               LEFT JOIN (SELECT category_id, count(*) AS n FROM entries WHERE kind = 'click' GROUP BY 1) c USING (category_id)
               LEFT JOIN (SELECT category_id, count(*) AS n FROM entries WHERE kind = 'order' GROUP BY 1) o USING (category_id)
               LEFT JOIN (SELECT category_id, count(*) AS n FROM entries WHERE kind = 'pay' GROUP BY 1) p USING (category_id)""",
            "entries"),
        "jon5_top_category_sessions": _with(
            """SELECT category_id, session_id, click_count FROM category_session
               WHERE category_id IN (SELECT category_id FROM top_category)""", "category_session", "top_category"),
        "jon6_top_session_detail": _with(
            f"SELECT category_id, {DETAIL_COLUMNS} FROM actions JOIN top_session t USING (session_id)",
            "actions", "top_session"),
        "jon7_click_city": _with("SELECT city_id, city_name, area, product_id FROM clicks_by_city", "clicks_by_city"),
        "jon8_area_product": _with(
            "SELECT area, product_id, click_count, product_name, product_status FROM area_full", "area_full"),
        "jon9_blacklist_anti": _with(clicks + "clean", "clean"),
        "jon10_map_join": _with("SELECT city_id, city_name, area, product_id FROM clicks_by_city", "clicks_by_city"),
        "jon11_skew_join": _with(
            """SELECT a.event_id, a.city_id, a.page_id, c.city_name, c.area FROM actions a
               JOIN city_info c USING (city_id)""", "actions", "city_info"),
        "jon11_skew_semi_join": _with(
            f"""SELECT {ACTION_COLUMNS} FROM actions
                WHERE session_id IN (SELECT session_id FROM user_sessions WHERE sex = 'male' AND age BETWEEN 20 AND 45)""",
            "actions", "user_sessions"),
        "jon11_sketched_join": _with(
            """SELECT a.event_id, a.city_id, a.page_id, c.city_name, c.area FROM actions a
               JOIN city_info c USING (city_id)""", "actions", "city_info"),
        "jon11_sketched_anti_join": _with(
            f"""SELECT {ACTION_COLUMNS} FROM actions
                WHERE session_id NOT IN (SELECT session_id FROM user_sessions WHERE sex = 'male' AND age BETWEEN 20 AND 45)""",
            "actions", "user_sessions"),
        "jon11_frequent_keys": _with(
            """SELECT page_id, city_id FROM actions WHERE page_id IS NOT NULL AND city_id IS NOT NULL GROUP BY page_id, city_id
               HAVING count(*) >= 0.004 * (SELECT count(*) FROM actions WHERE page_id IS NOT NULL AND city_id IS NOT NULL)""",
            "actions"),
        # aggregations
        "agg2_observed_stats": _with(_stats("user_sessions"), "user_sessions"),
        "agg1_session_rollup": _with(
            f"SELECT {SESSION_COLUMNS}, search_keywords, click_category_ids FROM sessions", "sessions"),
        "agg2_session_stats": _with(_stats("user_sessions"), "user_sessions"),
        "agg3_category_kinds": _with(
            "SELECT category_id, kind, count(*) AS row_count FROM entries GROUP BY ALL", "entries"),
        "agg5_session_category_clicks": _with(
            "SELECT category_id, session_id, click_count FROM category_session", "category_session"),
        "agg6_hourly_sessions": _with(f"SELECT {day}, hour, session_count FROM hours", "hours"),
        "agg7_hop_counts": _with("SELECT hop, count(*) AS hop_count FROM matched GROUP BY hop", "matched"),
        "agg8_start_page_views": _with(
            "SELECT count(*) AS start_page_views FROM actions WHERE page_id = 1", "actions"),
        "agg9_area_product_counts": _with(
            "SELECT area, product_id, click_count, city_infos FROM area_counts", "area_counts"),
        "agg10_salted_count": _with(
            "SELECT click_category_id, count(*) AS row_count FROM actions GROUP BY click_category_id", "actions"),
        "agg11_distinct_users": _with("SELECT DISTINCT user_id FROM user_ad WHERE click_count >= 2", "user_ad"),
        # windows, sort, sample, sets
        "win1_area_top_products": _with(area_top, "area_full"),
        "win2_province_top_ads": _with(f"SELECT {day}, province, ad_id, click_count FROM province_ads", "province_ads"),
        "win3_top_sessions": _with("SELECT category_id, session_id, click_count FROM top_session", "top_session"),
        "win4_bucketed_page_pairs": _with("SELECT session_id, prev_page_id, page_id FROM pairs", "pairs"),
        "win4_page_pairs": _with("SELECT session_id, prev_page_id, page_id FROM pairs", "pairs"),
        "srt1_top_categories": _with(counts + "top_category", "top_category"),
        "smp1_session_sample": _with(f"SELECT {SESSION_COLUMNS} FROM sample", "sample", total=1000),
        "smp1_session_sample_100": _with(f"SELECT {SESSION_COLUMNS} FROM sample", "sample", total=100),
        "smp1_session_sample_of_a_day": _with(
            f"""SELECT {SESSION_COLUMNS} FROM (
                    SELECT *, row_number() OVER (PARTITION BY hour(start_time) ORDER BY md5('0' || session_id), session_id) AS rn,
                           floor(cast(count(*) OVER (PARTITION BY hour(start_time)) AS DOUBLE) / cast(count(*) OVER () AS DOUBLE) * 100.0) AS quota
                    FROM user_sessions WHERE cast(start_time AS DATE) = DATE '2024-01-10')
                WHERE rn <= quota""", "user_sessions"),
        "smp1_session_sample_5000": _with(f"SELECT {SESSION_COLUMNS} FROM sample", "sample", total=5000),
        "set1_category_universe": _with("SELECT DISTINCT category_id FROM entries", "entries"),
        # page flow
        "fun1_flow_hops": _with("SELECT session_id, hop FROM matched", "matched"),
        "fun2_conversion_rates": _with("SELECT position, hop, hop_count, base_count, rate FROM rates", "rates"),
        "fun3_packed_rates": _with(
            "SELECT string_agg(hop || '=' || coalesce(cast(rate AS VARCHAR), 'null'), '|' ORDER BY position) AS convert_rate FROM rates",
            "rates"),
        # SQL functions
        "udf1_concat_long_string": _with(
            "SELECT city_id, city_id || ':' || city_name AS city_info FROM city_info", "city_info"),
        "udf2_json_field": _with(
            "SELECT product_id, json_extract_string(extend_info, '$.product_status') AS product_status FROM product_info",
            "product_info"),
        "udf2_variant_field": _with(
            """SELECT product_id, CASE WHEN product_id % 7 <> 0 THEN cast(json_extract_string(extend_info, '$.product_status') AS INTEGER) END
                      AS product_status FROM product_info""", "product_info"),
        "udf3_random_prefix": _with(
            "SELECT session_id, true AS prefix_in_range FROM actions", "actions"),
        "udf3_random_prefix_spread": _with("SELECT least(8, count(*)) AS prefixes FROM actions", "actions"),
        "udf4_remove_random_prefix": _with("SELECT session_id FROM actions", "actions"),
        "udf5_group_concat_distinct": _with(
            """SELECT area, array_to_string(list_sort(list(DISTINCT city_name)), ',') AS city_names
               FROM clicks_by_city GROUP BY area""", "clicks_by_city"),
        # streams
        "str1_clean_clicks": _with(clicks + "clean", "clean"),
        "str2_user_ad_counts": _with(f"SELECT {day}, user_id, ad_id, click_count FROM clean_user_ad", "clean_user_ad"),
        "str3_dynamic_blacklist": _with(
            """SELECT user_id FROM seed UNION SELECT user_id FROM clean_user_ad WHERE click_count >= 2""",
            "seed", "clean_user_ad"),
        "str2_counts_over_batches": _with(
            f"SELECT {day}, user_id, ad_id, click_count FROM user_ad_both", "user_ad_both"),
        "str3_threshold_over_batches": _with(
            "SELECT DISTINCT user_id FROM user_ad_both WHERE click_count >= 2", "user_ad_both"),
        "str4_running_totals": _with(
            f"SELECT {day}, province, city, ad_id, count(*) AS click_count FROM clean GROUP BY ALL", "clean"),
        "str5_province_top_ads": _with(
            f"""SELECT {day}, province, ad_id, click_count FROM (
                    SELECT date, province, ad_id, count(*) AS click_count FROM clean GROUP BY date, province, ad_id
                    QUALIFY row_number() OVER (PARTITION BY date, province ORDER BY count(*) DESC, ad_id) <= 3)""",
            "clean"),
        "str5_top_ads_over_batches": _with(
            f"""SELECT {day}, province, ad_id, click_count FROM (
                    SELECT date, province, ad_id, count(*) AS click_count FROM both_runs GROUP BY date, province, ad_id
                    QUALIFY row_number() OVER (PARTITION BY date, province ORDER BY count(*) DESC, ad_id) <= 3)""",
            "both_runs"),
        "str6_click_trend": _with(trend, "minutes"),
        "str6_trailing_hour": _with(
            f"""SELECT {MINUTE} AS minute_start, ad_id, click_count FROM minutes
                WHERE minute_start > (SELECT max(minute_start) FROM minutes) - INTERVAL 60 MINUTE""", "minutes"),
        "str6_trend_over_batches": _with(trend, "minutes"),
        "str6_sliding_clicks": _with(
            """SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS window_start,
                      strftime(window_start + INTERVAL 60 MINUTE, '%Y-%m-%d %H:%M') AS window_end,
                      ad_id, count(*) AS click_count
               FROM (SELECT time_bucket(INTERVAL 10 MINUTE, click_time) - to_minutes(10 * i) AS window_start, ad_id
                     FROM ad_clicks, range(6) t(i))
               GROUP BY ALL""", "ad_clicks"),
        "str4_totals_by_state": _with(stat, "ad_stat"),
        "str6_sliding_stream": _with(
            """SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS window_start,
                      strftime(window_start + INTERVAL 60 MINUTE, '%Y-%m-%d %H:%M') AS window_end,
                      ad_id, count(*) AS click_count
               FROM (SELECT time_bucket(INTERVAL 10 MINUTE, click_time) - to_minutes(10 * i) AS window_start, ad_id
                     FROM ad_clicks, range(6) t(i)
                     WHERE NOT (cast(click_time AS DATE) <= DATE '2024-01-05' AND minute(click_time) < 10))
               WHERE window_start + INTERVAL 60 MINUTE <= (SELECT max(click_time) FROM ad_clicks) - INTERVAL 2 DAY
               GROUP BY ALL""", "ad_clicks"),
        "str7_restart_with_new_clicks": _with(
            f"SELECT {day}, province, city, ad_id, count(*) AS click_count FROM both_runs GROUP BY ALL", "both_runs"),
        "str7_restart": _with(stat, "ad_stat"),
        # whole jobs
        "job_area_top_products": _with(area_top, "area_full"),
        "job_session_stats": _with(_stats(f"(SELECT * FROM user_sessions WHERE {filtered})"), "user_sessions"),
        "job_session_sample": _with(
            f"""SELECT session_id, {TIME.format('start_time')} AS start_time, nullif(search_keywords, '') AS search_keywords,
                nullif(click_category_ids, '') AS click_category_ids FROM sample""", "sample", total=1000),
        "job_top_categories": _with(counts + "top_category", "top_category"),
        "job_top_sessions": _with("SELECT category_id, session_id, click_count FROM top_session", "top_session"),
        "job_area_products_in_sql": _with(
            """SELECT area, product_id, product_name, product_status, click_count, city_infos FROM (
                   SELECT c.area, a.click_product_id AS product_id, p.product_name, count(*) AS click_count,
                          CASE WHEN json_extract_string(any_value(p.extend_info), '$.product_status') = '0' THEN 'Self' ELSE 'Third Party' END AS product_status,
                          array_to_string(list_sort(list(DISTINCT c.city_id || ':' || c.city_name)), ',') AS city_infos
                   FROM actions a JOIN city_info c USING (city_id) JOIN product_info p ON p.product_id = a.click_product_id
                   WHERE a.date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY c.area, a.click_product_id, p.product_name)
               QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) <= 3""",
            "actions", "city_info", "product_info"),
        "job_page_conversion_in_sql": _with("SELECT position, hop, hop_count, base_count, rate FROM rates", "rates"),
        "job_page_conversion": _with("SELECT position, hop, hop_count, base_count, rate FROM rates", "rates"),
    }
