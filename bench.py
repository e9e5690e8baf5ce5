"""Times the registered queries and prints one JSON line.

Each query is written to the no-op sink, so all rows and columns are computed. Every query runs
``BENCH_RUNS`` times after one warm-up; the median counts. Stream queries replay their table through
checkpointed micro-batches, mostly start-up time, and run once after the warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from receiptflow.plans.catalog import QUERIES
from receiptflow.plans.job_queries import forget
from receiptflow.session import prepare

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]


def is_stream(name: str) -> bool:
    return name.endswith(("_stream", "_batches")) or name.startswith("job_") or name in ("spend_processing_time", "enriched_table")


def seconds(spark: SparkSession, name: str) -> float:
    forget()
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("receiptflow-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    times = {}
    for name in ONLY or QUERIES:
        seconds(spark, name)
        runs = 1 if is_stream(name) else RUNS
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(runs)), 3)
    total = round(sum(times.values()), 3)
    line = {"metric": "total query time", "value": total, "unit": "sec", "queries": times, "sf": SF_DIR.rsplit("sf", 1)[-1]}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
