"""Benchmark of the headline queries.

Runs each query over the tables in ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` (default 8) and forces full
execution with the ``noop`` sink (every row computed, nothing collected).
Each query is first run once on the small tables of ``$BENCH_WARMUP_DIR``
(default sf0.01) to warm the JVM; the reported time is the best of
``$BENCH_ROUNDS`` (default 3) runs.  Prints one JSON line:
{"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.plans import catalog  # noqa: E402
from tallyspark.session import local_session  # noqa: E402

HEADLINE = [
    "kpi_mart",
    "kpi_mart_all_regions",
    "kpi_published",
    "kpi_non_null_profile",
    "customer_keys",
    "date_anchors",
    "reconcile_daily",
    "audit_rows",
    "table_count_audit",
]


def _sf(path: str) -> str:
    m = re.search(r"sf([0-9.]+)", path)
    return m.group(1) if m else path


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="tallyspark-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
    qs = catalog.queries()
    # warm the JVM (class loading, JIT, generated-code cache) once per query on small tables
    small = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(small):
        for name in HEADLINE:
            qs[name](spark, small).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(rounds):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": _sf(sf_dir), "cpus": cpus, "rounds": rounds, "timing": "best of rounds",
                      "warmup": os.path.basename(small.rstrip("/")) if os.path.isdir(small) else None}))


if __name__ == "__main__":
    main()
