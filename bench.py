"""Benchmark: the daily job's stages at one scale factor, one JSON line on stdout.

Stages mirror the timed tasks of the job being replaced (source validation, staging,
dimensions, fact, consumption, tests) plus the CSV ingest in front of them, an
incremental re-run and the 21-measure library over the written mart.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from salesmart.plans import measures as MS  # noqa: E402
from salesmart.plans.daily_run import read_perf, run_daily  # noqa: E402
from salesmart.registry import QUERIES  # noqa: E402
from salesmart.session import get_spark, scratch_path  # noqa: E402
from salesmart.sources.loads import load_feed  # noqa: E402
from salesmart.sources.testdata import raw_sales, write_feed  # noqa: E402

AS_OF = "1998-06-30"
NEXT_RUN = "1998-07-07"
# Filter context each measure is evaluated in for the bench.
MEASURE_CONTEXT = {"M7": ["YEAR", "MONTH"], "M11": ["REGION"], "M20": ["YEAR"]}


def _next_week(raw):
    """What the next run loads: the orders of the week, each with one unit more than in the first load."""
    week = (F.col("ORDER_DATE") > AS_OF) & (F.col("ORDER_DATE") <= NEXT_RUN)
    return raw.where(week).withColumn("UNITS_SOLD", F.col("UNITS_SOLD") + 1)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="salesmart-bench")
    timings: dict[str, float] = {}

    # warm-up on the smallest data set, not timed: JVM start, code generation and JIT of
    # every step (ingest and the daily job), so the timed run measures steady state
    small = "/root/testdata/sf0.001"
    QUERIES["t_sales_performance"](spark, small).count()
    warm = scratch_path(spark, "bench-warmup")
    load_feed(spark, write_feed(raw_sales(spark, small), f"{warm}/feed"), warm)
    run_daily(spark, None, warm, as_of=AS_OF, enforce_gates=False, enforce_tests=False, raw_root=warm)
    load_feed(spark, write_feed(_next_week(raw_sales(spark, small)), f"{warm}/feed-2"), warm)
    run_daily(spark, None, warm, as_of=AS_OF, enforce_gates=False, enforce_tests=False, raw_root=warm)

    # setup, not timed: the adapter tables written as the CSV feed the job ingests, and the feed of the next run
    feed = write_feed(raw_sales(spark, sf_dir), scratch_path(spark, "bench-feed"))
    feed_2 = write_feed(_next_week(raw_sales(spark, sf_dir)), scratch_path(spark, "bench-feed-2"))
    warehouse = scratch_path(spark, "bench-warehouse")

    t = time.perf_counter()
    audit = load_feed(spark, feed, warehouse)
    timings["ingest_csv"] = time.perf_counter() - t

    # the feed's ship dates precede order dates on many rows, so the gates are reported
    # but not enforced here
    run_daily(spark, None, warehouse, as_of=AS_OF, enforce_gates=False, enforce_tests=False,
              timings=timings, raw_root=warehouse)
    steps: dict[str, float] = {}
    load_feed(spark, feed_2, warehouse)
    t = time.perf_counter()
    run_daily(spark, None, warehouse, as_of=NEXT_RUN, enforce_gates=False, enforce_tests=False,
              timings=steps, raw_root=warehouse)
    timings["incremental_run"] = time.perf_counter() - t
    timings.update({f"incremental_{k}": v for k, v in steps.items()})

    perf = read_perf(spark, warehouse)
    t = time.perf_counter()
    for mid, fn in MS.MEASURES.items():
        fn(perf, MEASURE_CONTEXT.get(mid, ["REGION"])).collect()
    timings["measures_21"] = time.perf_counter() - t

    queries = {k: round(v, 3) for k, v in timings.items()}
    total = round(sum(timings[k] for k in ["ingest_csv", "validate_source", "staging", "dimensions",
                                           "fact", "consumption", "data_tests"]), 3)
    print(json.dumps({"metric": "daily_run_total", "value": total, "unit": "sec", "queries": queries,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": cpus, "rows_in": audit["loaded"] + audit["skipped"],
                      "rows_loaded": audit["loaded"]}))


if __name__ == "__main__":
    main()
