"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the threads. Each query runs once to warm up
and three times to be timed; its time is the median. All rows are computed, none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from clickweave.queries import THRESHOLD, queries
from clickweave.session import build_session
from clickweave.streaming.ad_monitor import CATCH_UP
from clickweave.streaming.replay import replay

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

BATCH = (
    "session_ratios", "session_full_info", "session_sample", "session_detail", "filtered_actions",
    "category_counts", "top10_categories", "top10_sessions", "page_conversion",
    "area_product_clicks", "regional_top3", "ad_log_parsed", "ad_user_clicks", "ad_blacklist",
    "ad_clicks_clean", "ad_city_clicks", "ad_province_top3", "ad_minute_trend", "ad_recent_hour",
)


def seconds(run: Callable[[], None]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("clickweave-bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()

    def batch(name: str) -> Callable[[], None]:
        return lambda: known[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    def stream() -> None:
        """The whole log through all five streaming queries, in three arrivals."""
        monitor = replay(spark, SF_DIR, THRESHOLD)
        for start in (monitor.start_ad_stat, monitor.start_province_top,
                      monitor.start_click_trend):
            start(CATCH_UP).awaitTermination()

    runs = {name: batch(name) for name in BATCH}
    times: dict[str, float] = {}
    for name, run in runs.items():
        run()
        times[name] = round(statistics.median(seconds(run) for _ in range(RUNS)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    stream()
    times["stream_ads"] = round(seconds(stream), 3)
    print("stream_ads", times["stream_ads"], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total of median query times", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(SF_DIR).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
