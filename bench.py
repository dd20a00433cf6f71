"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up the JVM and is then timed, building the plan included.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tests.sessions import make_session
from wattspark.plans import QUERIES

HEADLINE = (
    "a05_sag_events",
    "w04_rolling_low_count",
    "a11_five_minute_rollup",
    "a13_baseline",
    "a14_event_performance",
    "a18_hourly_health",
    "a19_daily_health",
    "a03_gauge_series",
    "d02_sag_events",
    "a31_delivery_stats",
    "a39_reading_gaps",
    "a28_eligible_periods",
    "a34_battery_cycles",
    "p10_enriched_readings",
    "p07_error_classes",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = make_session(cpus)
    seconds = {}

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    for name in HEADLINE:
        run(name)
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
