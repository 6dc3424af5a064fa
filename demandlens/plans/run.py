"""Q-batch: stage the inputs, check the snapshot gate, run the jobs and write each report section.

The only values that reach the driver are counts. Inputs are staged first (``plans.stage``): every
source table is read once, whatever the number of jobs. Every job is its own Spark job and its
own replacement of one section, in the job's order of rows.

A job that fails does not stop the others. What is finished is noted in the batch's folder, one
small file per job, under a name made of the day and the parameters. A batch that left jobs
open and is run again takes over the staged inputs and does only what is left; once every job
asked for is finished the folder goes, and the next run starts afresh.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from demandlens.params import Params
from demandlens.plans.jobs import JOBS
from demandlens.plans.stage import DIMENSION_KEYS, Staged, roles_of, stage, with_candidates
from demandlens.sinks.files import listed, read_json, remove, write_json
from demandlens.sinks.report import LABELS, current_version, write_section
from demandlens.sources.roles import assert_unique


class BatchResult(dict):
    """Job -> path of the section version written, or kept from the run before.

    ``loaded``: whether today's snapshot was there (else nothing is written). ``failed``: job ->
    error. ``resumed``: jobs finished by an earlier run. ``rejected``: role -> field -> values
    that became NULL. ``fan_out``: dimension -> key values that occur more than once.
    """

    def __init__(self):
        super().__init__()
        self.loaded = False
        self.failed: dict[str, str] = {}
        self.resumed: list[str] = []
        self.rejected: dict[str, dict[str, int]] = {}
        self.fan_out: dict[str, int] = {}


def preflight(roles: Mapping[str, DataFrame]) -> dict[str, int]:
    """Number of duplicated key values per dimension role present in ``roles``.

    One aggregation per dimension, without a batch; a batch counts the same while it stages.
    """
    out = {}
    for role, keys in DIMENSION_KEYS.items():
        if role in roles:
            out[role] = assert_unique(roles[role], keys).count()
    return out


def batch_folder(out_root: str, p: Params, display_labels: bool = False) -> str:
    """Where a batch of this day and these parameters keeps what it needs to go on."""
    named = sorted((k, str(v)) for k, v in dataclasses.asdict(p).items())
    digest = hashlib.sha256(repr((named, display_labels)).encode()).hexdigest()[:16]
    return f"{out_root}/_batch/{p.as_of.isoformat()}-{digest}"


def _finished(spark: SparkSession, folder: str, name: str, out_root: str) -> str | None:
    """The version that an earlier run of this batch wrote, if it still counts."""
    note = read_json(spark, f"{folder}/{name}.json")
    _, workbook, section = JOBS[name]
    if note and note["version"] == current_version(spark, f"{out_root}/{workbook}", section):
        return note["version"]
    return None


def run(roles: Mapping[str, DataFrame], p: Params, out_root: str,
        jobs: Iterable[str] | None = None, must_exist: bool = True,
        display_labels: bool = False, resume: bool = True,
        spark: SparkSession | None = None) -> BatchResult:
    """Run ``jobs`` (default: all, in batch order). The result is empty when today's snapshot is
    not loaded (nothing is written then).

    Reports must exist, or their jobs fail; ``must_exist=False`` creates those that do not.
    ``resume=False`` forgets what an unfinished run of the same batch left.
    """
    spark = spark or SparkSession.active()
    names = list(jobs or JOBS)
    folder = batch_folder(out_root, p, display_labels)
    if not resume:
        remove(spark, folder)
    out = BatchResult()
    left = []
    for name in names:
        version = _finished(spark, folder, name, out_root)
        if version:
            out[name] = version
            out.resumed.append(name)
        else:
            left.append(name)
    staged = stage(roles, p, f"{folder}/staged", roles_of(left)) if left else None
    out.loaded = staged is None or staged.gate_open
    if staged is not None:
        out.rejected, out.fan_out = staged.rejected(), staged.fan_out()
    if out.loaded:
        for name in left:
            try:
                out[name] = _write(name, staged, p, out_root, must_exist, display_labels)
                write_json(spark, f"{folder}/{name}.json", {"version": out[name]})
            except Exception as e:          # one job's failure is reported, not the batch's end
                out.failed[name] = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
    if not out.failed:
        remove(spark, folder)
        above = folder.rpartition("/")[0]
        if not listed(spark, above):
            remove(spark, above)
    return out


def _write(name: str, staged: Staged, p: Params, out_root: str, must_exist: bool,
           display_labels: bool) -> str:
    fn, workbook, section = JOBS[name]
    if name == "old_peaks":
        staged = with_candidates(staged, p)
    return write_section(fn(staged, p), f"{out_root}/{workbook}", section, must_exist=must_exist,
                         labels=LABELS.get(name) if display_labels else None)
