"""Time the headline queries: one JSON line with the warm median of three runs each."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from acceptance.queries import all_queries
from clickloom.session import build_session

HEADLINE = [
    "job_area_top_products",
    "job_session_stats",
    "job_session_sample",
    "job_top_categories",
    "job_top_sessions",
    "job_page_conversion",
    "agg1_session_rollup",
    "agg2_session_stats",
    "flt4_session_filter",
    "jon2_session_detail",
    "jon4_category_counts",
    "jon6_top_session_detail",
    "jon11_skew_join",
    "win1_area_top_products",
    "win2_province_top_ads",
    "win3_top_sessions",
    "win4_page_pairs",
    "smp1_session_sample",
    "snk2_upsert_replace",
    "str2_user_ad_counts",
    "str5_province_top_ads",
    "str6_click_trend",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    for name in HEADLINE:
        times = []
        for _ in range(1 + RUNS):
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total of warm medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
