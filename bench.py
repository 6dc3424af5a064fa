"""Time the monitoring jobs on one scale and print one JSON line.

Each job runs end to end from the raw test tables (role derivation included) and is
executed with the ``noop`` sink, so every row is produced but nothing is collected to the
driver. Building the plan is part of the time. Environment: ``BENCH_SF_DIR`` (default
/root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_REPEAT`` (runs per job, default 3).

The batch is run ``BENCH_REPEAT`` times in a row. ``queries`` holds each job's median time,
``cold_queries`` the first run, which includes JIT and whole-stage code generation. ``value``
sums the seven jobs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandlens.plans.registry import PIPELINES, QUERIES  # noqa: E402
from demandlens.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          driver_memory="16g")
    # warm-up: JVM class loading and parquet footers, not counted
    QUERIES["current_snapshot"](spark, sf_dir).collect()
    names = (*PIPELINES, "dbd_sections")
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(max(1, repeat)):
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - t0)
    times = {n: round(median(v), 3) for n, v in runs.items()}
    cold = {n: round(v[0], 3) for n, v in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "monitoring_batch_total",
                      "value": round(sum(times[n] for n in PIPELINES), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None,
                      "cold_total": round(sum(cold[n] for n in PIPELINES), 3),
                      "cold_queries": cold, "repeat": repeat, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
