"""Print the shape of each job's final (AQE) physical plan as a markdown table.

    python tools/plan_report.py [sf_dir] [--materialized folder] [--no-broadcast]

Counts shuffles, broadcasts, join strategies, windows, aggregates and scans, and lists the
pushed filters of every parquet scan. Each job is executed once first, so the plan shown is
the adaptive plan as it ran. With ``--materialized`` the role tables are first written to
parquet in a new folder inside ``folder`` (the forecast partitioned by ``snapshot_date``, as
recommended for production) and the jobs read them through ``sources.roles.load``. The
counts then show each job's own plan, without the test-table role derivation. With
``--no-broadcast`` no side is broadcast, the shape for dimensions beyond the threshold.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import uuid  # noqa: E402

from demandlens.plans import jobs  # noqa: E402
from demandlens.plans.registry import PIPELINES, QUERIES  # noqa: E402
from demandlens.session import local_session  # noqa: E402
from demandlens.sources.roles import load  # noqa: E402
from demandlens.sources.testdata import FIXTURE_PARAMS, derive  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
    "reused": r"ReusedExchange",
    "broadcasts": r"BroadcastExchange",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "windows": r"\bWindow \[",
    "aggregates": r"HashAggregate\(|ObjectHashAggregate\(",
    "scans": r"FileScan parquet|Scan parquet",
}


def _materialized(spark, sf_dir, inside):
    folder = f"{inside}/roles-{uuid.uuid4().hex}"
    roles = derive(spark, sf_dir)
    paths = {}
    for name in roles:
        paths[name] = os.path.join(folder, name)
        w = roles[name].write
        if name == "forecast":
            w = w.partitionBy("snapshot_date")
        w.parquet(paths[name])
    loaded = load(spark, paths)
    p = FIXTURE_PARAMS
    return {"current_snapshot": lambda: jobs.gate(loaded, p),
            "system_antipeaks": lambda: jobs.system_antipeaks(loaded, p),
            "old_peaks": lambda: jobs.old_peaks(loaded, p),
            "new_peaks": lambda: jobs.new_peaks(loaded, p),
            "antipeaks": lambda: jobs.antipeaks(loaded, p),
            "dbd_total": lambda: jobs.dbd_total(loaded, p),
            "dbd_reg": lambda: jobs.dbd_reg(loaded, p)}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.1")
    ap.add_argument("--materialized", metavar="folder")
    ap.add_argument("--no-broadcast", action="store_true")
    args = ap.parse_args()
    sf_dir = args.sf_dir
    spark = local_session(extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} if args.no_broadcast else None)
    if args.materialized:
        built = _materialized(spark, sf_dir, args.materialized)
        make = lambda name: built[name]()
    else:
        make = lambda name: QUERIES[name](spark, sf_dir)
    print("| job | rows | " + " | ".join(PATTERNS) + " |")
    print("| --- " * (len(PATTERNS) + 2) + "|")
    pushed = {}
    for name in PIPELINES:
        df = make(name)
        n = df._jdf.queryExecution().toRdd().count()         # runs this plan, keeps no rows
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]          # the plan as it ran
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        print(f"| {name} | {n} | " + " | ".join(counts) + " |")
        pushed[name] = (sorted(set(re.findall(r"PushedFilters: \[([^\]\n]*)", plan))),
                        sorted(set(re.findall(r"PartitionFilters: \[([^\]\n]*)", plan))))
    print()
    for name, (filters, parts) in pushed.items():
        print(f"* `{name}` pushed filters: " + "; ".join(f"`{f}`" for f in filters if f)
              + ("; partition filters: " + "; ".join(f"`{f}`" for f in parts if f)
                 if any(parts) else ""))
    spark.stop()


if __name__ == "__main__":
    main()
