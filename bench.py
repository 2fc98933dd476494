"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query is built and run
to a sink that discards its rows, twice; the shorter time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from evstream.operators import windows  # noqa: E402
from evstream.plans.queries import QUERIES  # noqa: E402
from evstream.plans.registry import Tables  # noqa: E402
from evstream.session import local_session  # noqa: E402

HEADLINE = [
    "pv_hourly", "uv_hourly", "uv_bitmap_running", "hot_items_top3", "hot_urls_top5",
    "marketing_by_channel", "marketing_total", "click_cap_pass", "clicks_by_province",
    "login_fail_state", "login_fail_pattern", "order_paid", "order_timeout", "order_status",
    "tx_match_inner", "tx_match_full", "sales_top3", "min_value_window", "traffic_slide",
    "traffic_count5_3", "traffic_session", "late_refire", "wordcount_space", "wordcount_nonword",
    "running_sum", "running_reduce_function", "changelog_sum", "latest_per_key", "jump_alert",
    "rise_alert", "user_aggregate_avg", "union_distinct", "json_filter_project",
]
STREAMS = ["stream_pv_hourly", "stream_order_status", "stream_running_reduce"]


def slide_1h_5s(spark, folder):
    """The widest window of the inventory: 720 windows per row."""
    events = Tables(spark, folder).events
    return windows.slide(events, "ts", "1 hour", "5 seconds", ["event_type"]).agg(
        F.count(F.lit(1)).alias("windows"), F.sum("cnt").alias("rows")
    )


def timed(run, spark, folder, rounds):
    times = []
    for _ in range(rounds):
        start = time.perf_counter()
        run(spark, folder).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")
    timed(QUERIES["pv_hourly"], spark, folder, 1)
    seconds = {name: timed(QUERIES[name], spark, folder, 2) for name in HEADLINE}
    seconds["slide_1h_5s"] = timed(slide_1h_5s, spark, folder, 2)
    seconds.update({name: timed(QUERIES[name], spark, folder, 2) for name in STREAMS})
    events = Tables(spark, folder).events.count()
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "events_rows": events,
    }))


if __name__ == "__main__":
    main()
