"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2), BENCH_QUERIES (comma separated names). Every query runs once
to warm up and then BENCH_RUNS times into a sink that computes all rows and columns;
the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapledger import build_session
from workload.queries import QUERIES

HEADLINE = [
    "latest_snapshot",
    "snapshot_history",
    "stage_crash",
    "stage_people",
    "stage_vehicle",
    "dim_datetime",
    "dim_location",
    "spatial_left_join",
    "dim_location_enriched",
    "fact_crash",
    "fact_vehicle",
    "fact_people",
    "upsert_rekeyed",
    "check_unique",
    "check_relationships",
    "report_trend",
    "report_severity",
    "report_geography",
    "report_cause_weather",
    "batch_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",")
    names = [n for n in names if n] or HEADLINE
    extra = {"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")}
    spark = build_session("bench", f"local[{cpus}]", int(cpus), extra)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        # The job writes all its tables itself, so once warm and once timed is enough.
        times = []
        for _ in range(2 if name == "batch_job" else runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
