"""The batch's mechanisms: atomic sections, staged inputs, recovery, rejected values, daily
partials, stored order, the forecast's layout."""

from __future__ import annotations

import os
import re
import uuid
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from demandlens.plans import daily, jobs
from demandlens.plans.run import batch_folder, run
from demandlens.plans.stage import roles_of, stage, with_candidates
from demandlens.sinks import files, layout, report
from demandlens.sinks.report import read_section, write_section
from demandlens.sources.roles import SCHEMAS, load
from demandlens.sources.testdata import FIXTURE_PARAMS, derive

SF0001 = "/root/testdata/sf0.001"
P = FIXTURE_PARAMS


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The role tables as parquet, the forecast by snapshot day."""
    root = tmp_path_factory.mktemp("roles")
    paths = {}
    for name, df in derive(spark, SF0001).items():
        paths[name] = str(root / name)
        (df.write.partitionBy("snapshot_date") if name == "forecast" else df.write).parquet(
            paths[name])
    return paths


@pytest.fixture()
def roles(spark, stored):
    return load(spark, stored)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def values(df):
    return [r.v for r in df.collect()]


def numbers(spark, *v):
    return spark.createDataFrame([(x,) for x in v], "v int")


# --- S4: one pointer, swapped last -------------------------------------------------------------

def test_a_writer_that_stops_leaves_the_old_rows(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "w")
    write_section(numbers(spark, 1), path, "s", must_exist=False)

    def stop(*_):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:                      # after the rows, before the pointer
        m.setattr(report, "publish", stop)
        with pytest.raises(RuntimeError):
            write_section(numbers(spark, 2), path, "s")
    assert values(read_section(spark, path, "s")) == [1]
    with monkeypatch.context() as m:                      # while the pointer is written
        m.setattr(report, "write_json", stop)
        with pytest.raises(RuntimeError):
            write_section(numbers(spark, 3), path, "s")
    assert values(read_section(spark, path, "s")) == [1]
    broken = numbers(spark, 4).select(F.raise_error(F.lit("bad row")).cast("int").alias("v"))
    with pytest.raises(Exception, match="bad row"):       # while the rows are written
        write_section(broken, path, "s")
    assert values(read_section(spark, path, "s")) == [1]
    left = [n for n in os.listdir(report.section_path(path, "s")) if n.startswith("v-")]
    assert len(left) > 1                                  # what the stopped writers left ...
    assert report.vacuum(spark, path, "s") == []          # ... might still be being written
    report.vacuum(spark, path, "s", older_than_s=-1)
    assert values(read_section(spark, path, "s")) == [1]
    assert len([n for n in os.listdir(report.section_path(path, "s")) if n.startswith("v-")]) == 1


def test_an_open_reader_keeps_its_version(spark, scratch):
    path = os.path.join(scratch, "w")
    write_section(numbers(spark, 1), path, "s", must_exist=False)
    opened = read_section(spark, path, "s")
    write_section(numbers(spark, 2), path, "s")
    assert values(opened) == [1] and values(read_section(spark, path, "s")) == [2]
    write_section(numbers(spark, 3), path, "s")
    held = [n for n in os.listdir(report.section_path(path, "s")) if n.startswith("v-")]
    assert len(held) == 1 + report.KEPT
    assert report.sections(spark, path) == ["s"]
    report.drop_section(spark, path, "s")
    assert report.sections(spark, path) == []
    with pytest.raises(FileNotFoundError):
        read_section(spark, path, "s")


def test_small_files_are_replaced_whole(spark, scratch):
    path = os.path.join(scratch, "x.json")
    assert files.read_json(spark, path) is None
    for content in ({"a": "é"}, {"b": [1, 2]}):
        files.write_json(spark, path, content)
        assert files.read_json(spark, path) == content
    assert [s.getPath().getName() for s in files.listed(spark, scratch)] == ["x.json"]
    assert files.listed(spark, os.path.join(scratch, "none")) == []


# --- T1, T2: order over many files --------------------------------------------------------------

def test_order_holds_over_many_files(spark, scratch):
    path = os.path.join(scratch, "w")
    df = spark.range(5000).select((F.xxhash64("id") % 1000).alias("k"), F.col("id").alias("v"))
    ordered = df.orderBy(F.col("k").desc(), "v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        where = write_section(ordered, path, "s", must_exist=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len([n for n in os.listdir(where) if n.endswith(".parquet")]) > 3
    got = read_section(spark, path, "s")
    assert got.columns == ["k", "v"]
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in ordered.collect()]


# --- Q-batch: one read per source ---------------------------------------------------------------

def scans(df, path):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"FileScan parquet[^\n]*" + re.escape(os.path.basename(path)) + r"\b", plan))


def test_batch_reads_every_source_once(spark, stored, roles, scratch, monkeypatch):
    from demandlens.plans import run as batch
    written = []
    keep = batch.write_section
    monkeypatch.setattr(batch, "write_section", lambda df, *a, **k: (written.append(df),
                                                                     keep(df, *a, **k))[1])
    staged_plans = []
    from demandlens.plans import stage as staging
    plan = staging._plan
    monkeypatch.setattr(staging, "_plan", lambda role, df, p: (lambda out: (
        staged_plans.append((role, out[0])), out)[1])(plan(role, df, p)))
    out = run(roles, P, scratch, must_exist=False, spark=spark)
    assert sorted(out) == sorted(jobs.JOBS) and not out.failed and out.loaded
    for role, where in stored.items():
        own = sum(scans(df, where) for r, df in staged_plans if r == role)
        assert own == 1, role
        assert sum(scans(df, where) for r, df in staged_plans if r != role) == 0
        assert sum(f"{os.path.dirname(where)}/{role}" in df._jdf.queryExecution().executedPlan()
                   .toString() for df in written) == 0
    # the snapshot range reaches the scan of the forecast
    forecast = next(df for r, df in staged_plans if r == "forecast")
    assert str(P.history_from) in forecast._jdf.queryExecution().executedPlan().toString().split(
        "PartitionFilters: [")[1].split("]")[0]


def test_staged_jobs_equal_direct_ones(spark, roles, scratch):
    staged = with_candidates(stage(roles, P, scratch, roles_of(jobs.JOBS)), P)
    assert staged.gate_open
    for name, (fn, _, _) in jobs.JOBS.items():
        assert rows_of(fn(staged, P)) == rows_of(fn(roles, P)), name


def test_gate_counts_any_forecast_day(spark, roles, scratch):
    """Today's snapshot counts as loaded even where its days lie outside the horizon."""
    late = roles["forecast"].withColumn("forecast_date", F.date_add("forecast_date", 400))
    staged = stage({**roles, "forecast": late}, P, scratch + "/a", ["forecast"])
    assert staged.gate_open and staged["forecast"].count() == 0
    none = roles["forecast"].where(F.col("snapshot_date") < F.lit(P.as_of))
    out = run({**roles, "forecast": none}, P, scratch + "/out", must_exist=False, spark=spark)
    assert out == {} and not out.loaded and not os.path.exists(scratch + "/out/dbd")


def test_candidates_prune_the_stock_without_broadcast(spark, roles, scratch):
    """Spark makes a Bloom filter of the candidates' keys; fewer stock rows are shuffled."""
    staged = with_candidates(stage(roles, P, scratch, roles_of(["old_peaks"])), P)
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
             "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        pruned = jobs.old_peaks(staged, P)
        plan = pruned._jdf.queryExecution().optimizedPlan().toString()
        got = rows_of(pruned)
        final = pruned._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "might_contain" in plan and "BroadcastHashJoin" not in final
    assert got == rows_of(jobs.old_peaks(roles, P))


# --- Q-batch: recovery ---------------------------------------------------------------------------

def test_failing_job_leaves_the_others_and_is_resumed(spark, roles, scratch, monkeypatch):
    names = ["new_peaks", "antipeaks", "dbd_reg"]

    def broken(*_):
        raise ValueError("no luck\nand more")
    with monkeypatch.context() as m:
        m.setitem(jobs.JOBS, "antipeaks", (broken, *jobs.JOBS["antipeaks"][1:]))
        first = run(roles, P, scratch, jobs=names, must_exist=False, spark=spark)
    assert sorted(first) == ["dbd_reg", "new_peaks"]
    assert first.failed == {"antipeaks": "ValueError: no luck"} and first.resumed == []
    # the source is not read again: it may be gone or changed
    gone = {r: df.where("1 = 0") for r, df in roles.items()}
    second = run(gone, P, scratch, jobs=names, must_exist=False, spark=spark)
    assert sorted(second.resumed) == ["dbd_reg", "new_peaks"] and not second.failed
    assert {n: second[n] for n in first} == dict(first)
    assert rows_of(read_section(spark, f"{scratch}/antipeaks", "antipeaks")) == rows_of(
        jobs.antipeaks(roles, P))
    assert not os.path.exists(batch_folder(scratch, P))
    # a finished batch that is run again starts afresh
    third = run(roles, P, scratch, jobs=["new_peaks"], spark=spark)
    assert third.resumed == [] and third["new_peaks"] != second["new_peaks"]


def test_section_replaced_since_is_done_again(spark, roles, scratch, monkeypatch):
    def broken(*_):
        raise ValueError
    with monkeypatch.context() as m:
        m.setitem(jobs.JOBS, "dbd_reg", (broken, *jobs.JOBS["dbd_reg"][1:]))
        run(roles, P, scratch, jobs=["new_peaks", "dbd_reg"], must_exist=False, spark=spark)
    write_section(numbers(spark, 1), f"{scratch}/new_peaks", "data")
    again = run(roles, P, scratch, jobs=["new_peaks"], spark=spark)
    assert again.resumed == [] and "v" not in read_section(
        spark, f"{scratch}/new_peaks", "data").columns


def test_other_parameters_are_another_batch(scratch):
    a, b = batch_folder(scratch, P), batch_folder(scratch, P.replace(ratio_min=7.0))
    assert a != b and a == batch_folder(scratch, P.replace())
    assert batch_folder(scratch, P, display_labels=True) != a


def test_missing_report_fails_its_job_only(spark, roles, scratch):
    report.create_report(spark, f"{scratch}/dbd")
    out = run(roles, P, scratch, jobs=["new_peaks", "dbd_total"], spark=spark)
    assert list(out) == ["dbd_total"] and "FileNotFoundError" in out.failed["new_peaks"]


# --- S3, Q10: what the passes counted -------------------------------------------------------------

def raw_tables(spark, scratch, roles):
    """Role tables as text: dates as yyyyMMdd, measures as text, some of both impossible."""
    paths = {}
    for name in ("forecast", "product_dict", "assortment"):
        df = roles[name]
        for f in SCHEMAS[name].fields:
            kind = f.dataType.simpleString()
            if kind == "date":
                df = df.withColumn(f.name, F.date_format(f.name, "yyyyMMdd"))
            elif kind != "string":
                df = df.withColumn(f.name, F.col(f.name).cast("string"))
        paths[name] = os.path.join(scratch, "raw", name)
        df.write.parquet(paths[name])
    return paths


def test_rejected_values_are_counted_in_the_pass(spark, roles, scratch):
    paths = raw_tables(spark, scratch, roles)
    good = spark.read.parquet(paths["forecast"])
    bad = good.limit(5).withColumn("forecast_date", F.lit("20260230")).unionByName(
        good.limit(3).withColumn("system_forecast", F.lit("12,5"))).unionByName(
        good.limit(2).withColumn("snapshot_date", F.lit("  ")))    # blank: missing, not rejected
    bad.write.mode("append").parquet(paths["forecast"])
    twice = spark.read.parquet(paths["product_dict"]).limit(4)
    twice.write.mode("append").parquet(paths["product_dict"])
    loaded = load(spark, paths, raw=True, observe=True)
    out = run(loaded, P, scratch, jobs=["new_peaks"], must_exist=False, spark=spark)
    assert out.rejected == {"forecast": {"forecast_date": 5, "system_forecast": 3}}
    assert out.fan_out == {"product_dict": 4, "assortment": 0}
    assert not out.failed
    want = jobs.new_peaks(load(spark, paths, raw=True), P)
    assert read_section(spark, f"{scratch}/new_peaks", "data").count() == want.count() > 0


def test_cli_reports_what_the_batch_found(spark, roles, scratch, capsys):
    import json

    from demandlens.__main__ import main
    paths = raw_tables(spark, scratch, roles)
    spark.read.parquet(paths["forecast"]).limit(2).withColumn("forecast_date", F.lit("19981399")
                                                              ).write.mode("append").parquet(paths["forecast"])
    cfg = os.path.join(scratch, "roles.json")
    with open(cfg, "w", encoding="utf-8") as fh:
        json.dump(paths, fh)
    args = ["--roles", cfg, "--out", os.path.join(scratch, "out"), "--as-of", "1998-06-15", "--raw",
            "--jobs", "new_peaks"]
    assert main(args, spark=spark) == 1                 # the report does not exist
    said = capsys.readouterr()
    assert "failed: new_peaks: FileNotFoundError" in said.err
    assert main([*args, "--create"], spark=spark) == 0
    assert "forecast.forecast_date: 2 values" in capsys.readouterr().err


# --- G1/U1, G10-G13: daily partials -----------------------------------------------------------------

def test_partials_equal_the_full_recomputation(spark, roles, scratch):
    yesterday = P.replace(as_of=P.day(1))
    for kind in daily.KINDS:
        assert len(daily.refresh(spark, roles, yesterday, scratch, kind)) == P.history_days
        assert daily.refresh(spark, roles, P, scratch, kind) == [P.history_to]   # one new day
        assert daily.refresh(spark, roles, P, scratch, kind) == []
        held = report.sections(spark, f"{scratch}/{kind}")
        assert held == [d.isoformat() for d in daily.window(P)]                  # oldest dropped
    kept = daily.with_partials(spark, roles, P, scratch)
    for name in ("system_antipeaks", "dbd_total", "dbd_reg"):
        fn = jobs.JOBS[name][0]
        assert rows_of(fn(kept, P)) == rows_of(fn(roles, P)), name


def test_replayed_day_counts_once(spark, roles, scratch):
    day = P.day(3)
    daily.refresh(spark, roles, P, scratch, "sales")
    more = roles["daily_sales"].withColumn("sc_quantity", F.when(
        F.col("calc_date") == F.lit(day), F.col("sc_quantity") * 2).otherwise(
        F.col("sc_quantity")).cast("decimal(18,3)"))
    late = {**roles, "daily_sales": more}
    for _ in range(2):
        assert daily.refresh(spark, late, P, scratch, "sales", again=[day]) == [day]
    kept = {**late, "sales_per_plu": daily.partial(spark, P, scratch, "sales")}
    assert rows_of(jobs.dbd_total(kept, P)) == rows_of(jobs.dbd_total(late, P))
    assert rows_of(jobs.dbd_total(kept, P)) != rows_of(jobs.dbd_total(roles, P))


def test_history_partial_reads_today_only(spark, stored, roles, scratch):
    """With the partial, the forecast scan is cut to today's snapshot; a day reads its own."""
    daily.refresh(spark, roles, P, scratch, "history")
    kept = {**roles, "history_totals": daily.partial(spark, P, scratch, "history")}
    plan = jobs.system_antipeaks(kept, P)._jdf.queryExecution().executedPlan().toString()
    filters = [s.split("]")[0] for s in plan.split("PartitionFilters: [")[1:] if "snapshot" in s.split("]")[0]]
    assert filters and all(f"= {P.as_of}" in f or str(P.as_of) in f for f in filters)
    assert not any(str(P.history_from) in f for f in filters)
    day = daily.history_day(roles, P, P.day(2))._jdf.queryExecution().executedPlan().toString()
    assert str(P.day(2)) in day.split("PartitionFilters: [")[1].split("]")[0]


def test_partial_of_an_empty_or_missing_day(spark, roles, scratch):
    none = {**roles, "daily_sales": roles["daily_sales"].where("1 = 0")}
    daily.refresh(spark, none, P, scratch, "sales")
    assert daily.partial(spark, P, scratch, "sales").collect() == []
    with pytest.raises(FileNotFoundError, match=P.as_of.isoformat()):
        daily.partial(spark, P.replace(as_of=P.as_of + timedelta(days=1)), scratch, "sales")


# --- W1-W6: the layout ------------------------------------------------------------------------------

def test_layout_needs_no_exchange_and_replaces_days(spark, roles):
    table = f"forecast_{uuid.uuid4().hex[:8]}"
    layout.create_forecast(roles["forecast"], table, buckets=4)
    try:
        laid = {**roles, "forecast": load(spark, {"forecast": table})["forecast"]}
        first = jobs.peak_candidates(laid, P)
        plan = first._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and str(P.as_of) in plan.split("PartitionFilters: [")[1]
        assert rows_of(jobs.old_peaks(laid, P)) == rows_of(jobs.old_peaks(roles, P))
        today = roles["forecast"].where(F.col("snapshot_date") == F.lit(P.as_of))
        before = spark.table(table).count()
        for _ in range(2):                              # a replay leaves no duplicates
            layout.replace_snapshot(roles["forecast"], table, P.as_of, buckets=4)
        assert spark.table(table).count() == before
        layout.replace_snapshot(today.limit(1), table, P.as_of, buckets=4)
        assert spark.table(table).count() == before - today.count() + 1
        per_day = (spark.table(table).select("snapshot_date", F.input_file_name().alias("f"))
                   .distinct().groupBy("snapshot_date").count())
        assert per_day.agg(F.max("count")).first()[0] <= 4
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
