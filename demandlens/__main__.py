"""Daily batch from the command line.

    python -m demandlens --roles roles.json --out s3://bucket/reports [--as-of 2026-01-20]
                         [--params params.json] [--jobs new_peaks,dbd_total] [--create]
                         [--labels] [--check-dimensions] [--explain]

``roles.json`` maps each role to a parquet path or a catalog table name (see
``sources.roles.load``); ``--raw`` conforms raw tables (source headers, text dates, padded
codes) at load. ``--columns`` names a JSON file role -> source header -> field for headers
beside the documented ones.
``params.json`` overrides thresholds and lists by name (``Params`` fields), e.g.
``{"min_stores": 40, "store_formats": ["Mahalla", "Supermarket"]}``.
``--as-of`` defaults to the current date of the machine that submits the batch. It is read
once here, and every job uses that one value. The exit code is 2 when today's snapshot is not
loaded, in which case nothing is written, and 1 when a job failed: the others are written, and
the same command run again does what is left (``--restart`` does everything again). Values that
could not be read (``--raw``) and repeated dimension keys are reported.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date

from pyspark.sql import SparkSession

from demandlens.params import Params
from demandlens.plans.jobs import JOBS
from demandlens.plans.run import preflight, run
from demandlens.sources.roles import load


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="demandlens", description=__doc__.split("\n\n")[0])
    ap.add_argument("--roles", required=True, help="JSON file: role -> path or table")
    ap.add_argument("--out", required=True, help="report root folder")
    ap.add_argument("--as-of", type=date.fromisoformat, default=None)
    ap.add_argument("--params", default=None, help="JSON file: Params overrides")
    ap.add_argument("--jobs", default=",".join(JOBS), help="comma-separated job names")
    ap.add_argument("--create", action="store_true",
                    help="create reports that do not exist (else a missing one stops the batch)")
    ap.add_argument("--labels", action="store_true", help="write display headers")
    ap.add_argument("--raw", action="store_true", help="conform raw role tables at load")
    ap.add_argument("--columns", default=None, help="JSON file: role -> source header -> field")
    ap.add_argument("--check-dimensions", action="store_true",
                    help="report duplicate dimension keys (they fan out results) before the run")
    ap.add_argument("--restart", action="store_true",
                    help="forget what an unfinished run of the same batch left")
    ap.add_argument("--explain", action="store_true",
                    help="print each job's formatted physical plan; run and write nothing")
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName("demandlens").getOrCreate()
    with open(args.roles, encoding="utf-8") as fh:
        paths = json.load(fh)
    columns = None
    if args.columns:
        with open(args.columns, encoding="utf-8") as fh:
            columns = json.load(fh)
    roles = load(spark, paths, raw=args.raw, columns=columns,
                 observe=args.raw and not (args.explain or args.check_dimensions))
    overrides = {}
    if args.params:
        with open(args.params, encoding="utf-8") as fh:
            overrides = json.load(fh)
    if args.as_of is not None:
        overrides["as_of"] = args.as_of.isoformat()
    overrides.setdefault("as_of", date.today().isoformat())
    p = Params.from_dict(overrides)
    names = [n for n in args.jobs.split(",") if n]
    unknown = sorted(set(names) - set(JOBS))
    if unknown:
        ap.error(f"unknown jobs: {unknown}")
    if args.check_dimensions:
        for role, n in preflight(roles).items():
            if n:
                print(f"warning: {role} has {n} duplicated key values; joins fan out",
                      file=sys.stderr)
    if args.explain:
        for name in names:
            print(f"== {name} ==")
            JOBS[name][0](roles, p).explain("formatted")
        return 0
    written = run(roles, p, args.out, jobs=names, must_exist=not args.create,
                  display_labels=args.labels, resume=not args.restart, spark=spark)
    if not written.loaded:
        print(f"snapshot {p.as_of} not loaded; nothing written", file=sys.stderr)
        return 2
    for role, fields in written.rejected.items():
        for field, n in fields.items():
            print(f"warning: {role}.{field}: {n} values could not be read", file=sys.stderr)
    for role, n in written.fan_out.items():
        if n:
            print(f"warning: {role} has {n} duplicated key values; joins fan out", file=sys.stderr)
    for name, path in written.items():
        print(f"{name}\t{path}")
    for name, error in written.failed.items():
        print(f"failed: {name}: {error}", file=sys.stderr)
    return 1 if written.failed else 0


if __name__ == "__main__":
    sys.exit(main())
