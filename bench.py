"""Headline queries on one directory of tables; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores).
Each query runs once to warm up and then BENCH_RUNS times (default 1); the
median is reported.  Results are consumed by the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from palisade.catalog import QUERIES  # noqa: E402
from palisade.session import build_session, use_scratch  # noqa: E402

use_scratch(tempfile.mkdtemp(prefix="palisade-bench-"))

HEADLINE = [
    "logon_features",
    "d03_http_daily_approximate",
    "d05_file_daily",
    "d09_email_deviation",
    "labelled_user_day",
    "d12_imbalance",
    "d18_feature_summary",
    "d24_correlation",
    "d30_separation",
    "d33_histogram",
    "f01_min_max",
    "f06_four_way_split",
    "f19_mutual_information",
    "f15_two_stage_detector",
    "f17_best_thresholds",
    "e02_drift_events",
    "g01_endpoint_snapshots",
    "g04_cooldown",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "palisade-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
