"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and run to completion through the `noop` sink (full
execution, no driver collect).  The first run of a query pays one-off JVM
costs (code generation, JIT); it is reported under `cold`.  The query's
time is the median of the following `BENCH_RUNS` runs (default 3), each of
which rebuilds the DataFrame from the parquet files.  Prints one JSON line.
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
    "intervals_robust",
    "intervals_adjacent",
    "intervals_ordinal",
    "intervals_first_exit",
    "contacts_include",
    "contacts_exclude",
    "contacts_sweep_include",
    "contacts_first_exit",
    "overlap_counts",
    "stays_contacts_include",
    "reconcile_report",
]


def _run(q, spark, sf_dir) -> float:
    t0 = time.perf_counter()
    q(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    keys = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k] or HEADLINE
    from towertrace.session import build_session
    from towertrace.plans.registry import QUERIES

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    _run(QUERIES["cdr_scan"], spark, sf_dir)  # JVM and parquet warm-up
    times, cold = {}, {}
    for k in keys:
        cold[k] = round(_run(QUERIES[k], spark, sf_dir), 3)
        times[k] = round(statistics.median(_run(QUERIES[k], spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf,
                      "cold": cold, "cold_total": round(sum(cold.values()), 3),
                      "runs": runs, "cpus": cpus}))


if __name__ == "__main__":
    main()
