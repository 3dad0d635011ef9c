"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs end to end from the driver's tables, plan building included, into Spark's ``noop`` sink:
once (``first_call``), then ``BENCH_RUNS`` (default 3) times, of which the median is reported. Nothing is
copied or kept between calls. Prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "portfolio_mart",
    "stage_payments",
    "collections_daily",
    "q1_disbursement",
    "q2_collections",
    "q3_cohort_health",
    "q4_top_delinquent",
    "q5_bi_ordered",
    "q5_exec_summary",
    "portfolio_kpis",
    "quality_report",
    "incremental_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from loanlake.plans.catalog import QUERIES
    from loanlake.session import get_session

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    t0 = time.perf_counter()
    spark = get_session(f"local[{cpus}]", shuffle_partitions=shuffle, app_name="loanlake-bench")
    session_sec = round(time.perf_counter() - t0, 3)
    timings: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        first[name] = round(time.perf_counter() - t0, 3)  # compiles code; planning included, as below
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "shuffle_partitions": shuffle,
        "runs": runs,
        "first_call": first,
        "session_sec": session_sec,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
