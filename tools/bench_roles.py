"""Time the jobs on role tables stored as parquet (the production shape).

    python tools/bench_roles.py folder [sf_dir] [repeat]

The roles are derived from the test tables once and written to a new folder inside ``folder``
(shared, where executors are on other machines), with the forecast partitioned by
``snapshot_date``. The write time
is reported separately: in production these tables exist and grow by one snapshot a day.
Each job then runs ``repeat`` times to the ``noop`` sink over ``sources.roles.load``; the
plan is built in the timed part, and the median time is printed as one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from demandlens.plans import jobs  # noqa: E402
from demandlens.session import local_session  # noqa: E402
from demandlens.sources.roles import load  # noqa: E402
from demandlens.sources.testdata import FIXTURE_PARAMS, derive  # noqa: E402

JOB_FNS = {"current_snapshot": jobs.gate, "system_antipeaks": jobs.system_antipeaks,
           "old_peaks": jobs.old_peaks, "new_peaks": jobs.new_peaks,
           "antipeaks": jobs.antipeaks, "dbd_total": jobs.dbd_total, "dbd_reg": jobs.dbd_reg}


def main() -> None:
    folder = f"{sys.argv[1]}/roles-{uuid.uuid4().hex}"
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    repeat = int(sys.argv[3]) if len(sys.argv) > 3 else 5
    spark = local_session()
    roles = derive(spark, sf_dir)
    t0 = time.perf_counter()
    paths = {}
    for name in roles:
        paths[name] = f"{folder}/{name}"
        writer = roles[name].write
        if name == "forecast":
            writer = writer.partitionBy("snapshot_date")
        writer.parquet(paths[name])
    write_sec = time.perf_counter() - t0
    took = {}
    for name, fn in JOB_FNS.items():
        times = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(load(spark, paths), FIXTURE_PARAMS).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        took[name] = round(median(times), 3)
    print(json.dumps({"metric": "jobs_on_role_tables", "value": round(sum(took.values()), 3),
                      "unit": "sec", "queries": took, "roles_write_sec": round(write_sec, 1),
                      "sf_dir": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
