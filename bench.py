"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR    folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS      local cores (default: all)
BENCH_RUNS      timed runs per query after a warm-up run (default 3); the median counts
BENCH_QUERIES   comma-separated names (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = [
    "jsonl_date_window",
    "bookings_canonical",
    "revenue_usd",
    "revenue_usd_udf",
    "merge_upsert",
    "merge_actions",
    "merge_repeated_keys",
    "external_upsert",
    "published_current",
    "compact_files",
    "booking_job",
    "sync_run",
    "orphan_files",
    "dataset_compare",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("staymart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")

    seconds = {}
    for name in names:
        timed = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timed[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
                "runs": runs,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
