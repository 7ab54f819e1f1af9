"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then three times; the median counts. Searches over grids of models, which take
much longer than what a first run costs besides, run once. The result is
written to the ``noop`` sink, so all columns of all rows are computed.
"""

import json
import os
import statistics
import time

from shiftlode.registry import QUERIES
from shiftlode.session import local_session

HEADLINE = [
    "daily_metrics",
    "table_quality",
    "production_anomalies",
    "feature_table",
    "validation_report",
    "duplicate_flags",
    "duplicate_count",
    "orphan_rows",
    "iqr_outliers",
    "forward_fill",
    "describe_table",
    "histogram_raw",
    "error_metrics",
    "scan_insert_dump",
    "tune",
    "run_forecast",
    "random_forest",
]
SEARCHES = {"run_forecast", "random_forest"}
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, "bench")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        if name in SEARCHES:
            seconds[name] = round(run(name), 3)
            continue
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores) if cores.isdigit() else cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
