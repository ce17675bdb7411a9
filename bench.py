"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on ``local[BENCH_CPUS]``. Each query runs
once untimed, to leave compilation and file caches out, and then ``BENCH_RUNS`` times; the best
counts. ``BENCH_QUERIES`` takes a comma-separated list instead of the headline queries.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from parity.queries import QUERIES, SPECS
from yearwheel.session import configured

HEADLINE = [
    *[f"extract_{n}" for n in SPECS],
    *[f"cube_{n}" for n in SPECS],
    "rolling_year_base",
    "trip_stay_join",
    "spend_long",
    "forward_fill",
    "los_band",
    "year_end_unpivot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configured(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        best = float("inf")
        for run in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:
                best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    total = round(sum(seconds.values()), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
