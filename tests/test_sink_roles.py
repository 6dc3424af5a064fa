"""Report sink (S4, S5), batch run, role conformance (S1, S3) and invariants."""

from __future__ import annotations

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandlens.plans import jobs
from demandlens.plans.registry import QUERIES
from demandlens.plans.run import run
from demandlens.sinks.report import (LABELS, create_report, normalise_dates, read_section,
                                     write_section)
from demandlens.sources.roles import SCHEMAS, assert_unique, conform, load, project
from demandlens.sources.testdata import FIXTURE_PARAMS, derive

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


# --- S4: one section replaced, the sibling kept ---------------------------------------------

def test_section_overwrite_keeps_sibling(spark, scratch):
    path = os.path.join(scratch, "dbd")
    write_section(spark.createDataFrame([(1,)], "v int"), path, "reg", must_exist=False)
    write_section(spark.createDataFrame([(2,), (3,)], "v int"), path, "total")
    write_section(spark.createDataFrame([(4,)], "v int"), path, "reg")
    assert sorted(r.v for r in read_section(spark, path, "reg").collect()) == [4]
    assert sorted(r.v for r in read_section(spark, path, "total").collect()) == [2, 3]


def test_must_exist(spark, scratch):
    with pytest.raises(FileNotFoundError):
        write_section(spark.createDataFrame([(1,)], "v int"), os.path.join(scratch, "none"), "x")
    create_report(spark, os.path.join(scratch, "none"))         # empty, but there
    write_section(spark.createDataFrame([(1,)], "v int"), os.path.join(scratch, "none"), "x")


def test_empty_result_replaces_the_section(spark, scratch):
    path = os.path.join(scratch, "r")
    write_section(spark.createDataFrame([(1,)], "v int"), path, "a", must_exist=False)
    write_section(spark.createDataFrame([(2,)], "v int"), path, "b")
    write_section(spark.createDataFrame([], "v int"), path, "a")
    got = read_section(spark, path, "a")
    assert got.collect() == [] and got.dtypes == [("v", "int")]
    assert [r.v for r in read_section(spark, path, "b").collect()] == [2]
    assert sorted(os.listdir(path)) == ["section=a", "section=b"]


def test_batch_replaces_a_section_by_an_empty_result(spark, scratch):
    roles = derive(spark, SF0001)
    path = os.path.join(scratch, "new_peaks")
    run(roles, FIXTURE_PARAMS, scratch, jobs=["new_peaks"], must_exist=False)
    assert read_section(spark, path, "data").count() > 0
    run(roles, FIXTURE_PARAMS.replace(ratio_min=1e9), scratch, jobs=["new_peaks"])
    got = read_section(spark, path, "data")
    assert got.count() == 0 and len(got.columns) == 16


@pytest.mark.parametrize("names", [["dbd_reg", "dbd_total"], ["dbd_total"], ["dbd_reg"]])
def test_written_sales_sections_keep_their_order(spark, scratch, names):
    run(derive(spark, SF001), FIXTURE_PARAMS, scratch, jobs=names, must_exist=False)
    for name in names:
        d1 = [r.d1 for r in read_section(spark, os.path.join(scratch, "dbd"), name[4:]).collect()]
        assert len(d1) == 102
        assert d1 == sorted(d1, key=lambda v: (v is not None, -(v or 0)))


def test_display_labels(spark, scratch):
    df = spark.createDataFrame([(1.0, 2.0)], "d1 double, wow_7 double")
    write_section(df, os.path.join(scratch, "w"), "total", labels=LABELS["dbd_total"],
                  must_exist=False)
    got = read_section(spark, os.path.join(scratch, "w"), "total")
    assert got.columns == ["1 day ago", "7_Рост %"]


def test_normalise_dates(spark):
    df = spark.createDataFrame([("2024-03-01 10:00:00",)], "forecast_date string")
    out = normalise_dates(df)
    assert dict(out.dtypes)["forecast_date"] == "date"
    assert out.first().forecast_date == date(2024, 3, 1)
    other = spark.createDataFrame([(1,)], "x int")
    assert normalise_dates(other) is other


# --- Q-batch ------------------------------------------------------------------------------------

def test_batch_run_writes_all_sections(spark, scratch):
    roles = derive(spark, SF0001)
    written = run(roles, FIXTURE_PARAMS, scratch, must_exist=False)
    assert set(written) == set(jobs.JOBS)
    total = read_section(spark, os.path.join(scratch, "dbd"), "total")
    assert total.count() == 18
    assert read_section(spark, os.path.join(scratch, "dbd"), "reg").count() == 18
    assert read_section(spark, os.path.join(scratch, "new_peaks"), "data").count() == 104


def test_batch_stops_without_snapshot(spark, scratch):
    roles = derive(spark, SF0001)
    p = FIXTURE_PARAMS.replace(as_of=date(2030, 1, 1))
    assert run(roles, p, scratch) == {}
    assert os.listdir(scratch) == []


# --- S3: conform ----------------------------------------------------------------------------------

def test_conform_dates_blanks_and_case(spark):
    raw = spark.createDataFrame(
        [("20260119", "20260119", "  ", "", "007 ", "S1 ", 1, "12.5"),
         ("20260230", "20260119", "D1", "P1", "7", "S1", 0, "3")],
        "FORECAST_DATE string, snapshot_date string, diag_id string, OFR_ID string, "
        "MATERIAL string, store string, promo_flag int, system_forecast string")
    absent = ("s4_adjustment", "car_adjustment", "approved_forecast")
    out = conform(raw, "forecast", optional=absent)
    assert out.schema == SCHEMAS["forecast"]
    rows = out.orderBy("promo_flag").collect()
    assert rows[0].forecast_date is None                       # impossible date -> NULL
    assert rows[1].forecast_date == date(2026, 1, 19)
    assert rows[1].diag_id == "" and rows[1].store == "S1"      # blank-padded -> ''
    assert (rows[1].material, rows[0].material) == ("007", "7")  # keys are text
    assert rows[1].system_forecast == 12.5 and rows[1].s4_adjustment is None


def test_missing_column_raises(spark):
    raw = spark.createDataFrame([("1", "S1")], "plu string, zavod string")
    for shape in (conform, project):
        with pytest.raises(ValueError, match="role assortment: required column az_type"):
            shape(raw, "assortment")
        assert shape(raw, "assortment", optional=["az_type"]).first().az_type is None


SOURCE_HEADERS = {"Материал": "material", "Категорийный_менеджм": "manager", "Название": "name",
                  **{f"Узел_{k}": f"node_{k}" for k in range(2, 6)},
                  **{f"Описание_{k}": f"node_{k}_name" for k in range(2, 6)}}


def test_source_headers_run_all_jobs(spark, scratch):
    """Tables with the source's headers, text dates and padded codes: every job has rows."""
    roles, paths = derive(spark, SF0001), {}
    for name, df in roles.items():
        if name == "product_dict":
            df = df.select(*[F.col(v).alias(k) for k, v in SOURCE_HEADERS.items()])
        elif name == "store_dict":
            df = df.select(F.col("number").alias("Номер"), F.col("type_cf").alias("Тип_CF"))
        elif name == "user_login":
            df = df.select(F.col("category_manager").alias("boss"), "user")
        else:
            df = df.select(*[F.date_format(c, "yyyyMMdd").alias(c.upper()) if t == "date"
                             else F.col(c) for c, t in df.dtypes])
        paths[name] = os.path.join(scratch, name)
        df.write.parquet(paths[name])
    with pytest.raises(ValueError, match="category_manager"):
        load(spark, paths, raw=True)
    loaded = load(spark, paths, raw=True, columns={"user_login": {"boss": "category_manager"}})
    for name, (fn, _, _) in jobs.JOBS.items():
        assert (sorted(map(str, fn(loaded, FIXTURE_PARAMS).collect()))
                == sorted(map(str, fn(roles, FIXTURE_PARAMS).collect()))), name
        assert fn(loaded, FIXTURE_PARAMS).count() > 0, name


def test_load_parquet_roles(spark, scratch):
    roles = derive(spark, SF0001)
    path = os.path.join(scratch, "plu_cat")
    roles["plu_cat"].write.parquet(path)
    loaded = load(spark, {"plu_cat": path})
    assert loaded["plu_cat"].count() == 181
    assert loaded["plu_cat"].schema == SCHEMAS["plu_cat"]


def test_assert_unique(spark):
    roles = derive(spark, SF0001)
    assert assert_unique(roles["product_dict"], ["material"]).count() == 0
    assert assert_unique(roles["sales_stock"], ["material"]).count() > 0


# --- invariants -------------------------------------------------------------------------------------

def test_total_row_is_sum_of_cells(spark):
    df = QUERIES["dbd_total"](spark, SF001)
    rows = df.collect()
    total = rows[[r.user for r in rows].index(FIXTURE_PARAMS.total_label)]
    others = [r for r in rows if r.user != FIXTURE_PARAMS.total_label]
    for k in range(1, 15):
        assert total[f"d{k}"] == pytest.approx(sum(r[f"d{k}"] or 0.0 for r in others))


def test_dbd_sorted_by_yesterday_desc(spark):
    d1 = [r.d1 for r in QUERIES["dbd_reg"](spark, SF001).collect()]
    nulls = [x for x in d1 if x is None]
    assert d1[:len(nulls)] == nulls
    assert d1[len(nulls):] == sorted(d1[len(nulls):], reverse=True)


def test_one_row_per_material_and_series(spark):
    sap = QUERIES["system_antipeaks"](spark, SF001)
    mats = [r.material for r in sap.collect()]
    assert mats == sorted(set(mats))                         # unique and ordered (T4)
    fv = QUERIES["first_violation"](spark, SF001)
    assert fv.count() == fv.select("sku", "store").distinct().count()


def test_antipeaks_ordered(spark):
    rows = [(r.forecast_date, r.material) for r in QUERIES["antipeaks"](spark, SF001).collect()]
    assert rows == sorted(rows)


def test_as_of_shift_invariance(spark):
    """Shifting every date of the data and as_of by the same days leaves the results unchanged."""
    roles = derive(spark, SF0001)
    shift = 364                                          # whole weeks keep weekday flags
    moved = {}
    for name, df in roles.items():
        cols = [F.date_add(F.col(c), shift).alias(c) if t == "date" else F.col(c)
                for c, t in df.dtypes]
        moved[name] = df.select(*cols)
    p = FIXTURE_PARAMS
    p2 = p.replace(as_of=p.as_of + timedelta(days=shift),
                   stock_ref_from=p.stock_from + timedelta(days=shift),
                   stock_ref_to=p.stock_to + timedelta(days=shift))
    for job in ("new_peaks", "antipeaks", "dbd_total", "system_antipeaks"):
        fn = jobs.JOBS[job][0]
        a = fn(roles, p).drop("forecast_date").collect()
        b = fn(moved, p2).drop("forecast_date").collect()
        assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str), job


# --- O4: forecast laid out by snapshot day -> the job reads today's partition only -----------

def test_snapshot_partition_pruning(spark, scratch):
    roles = derive(spark, SF0001)
    p = FIXTURE_PARAMS
    path = os.path.join(scratch, "forecast")
    (roles["forecast"].where(F.col("snapshot_date") >= F.lit(p.as_of - timedelta(days=20)))
     .write.partitionBy("snapshot_date").parquet(path))
    loaded = dict(roles)
    loaded["forecast"] = load(spark, {"forecast": path})["forecast"]
    df = jobs.new_peaks(loaded, p)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "1998-06-15" in plan
    assert df.count() == jobs.new_peaks(roles, p).count()


# --- command line ----------------------------------------------------------------------------

def test_cli_batch(spark, scratch):
    import json

    from demandlens.__main__ import main
    roles = derive(spark, SF0001)
    paths = {}
    for name in ("forecast", "sales_stock", "product_dict", "assortment", "store_dict",
                 "daily_sales", "plu_cat", "user_login"):
        paths[name] = os.path.join(scratch, "roles", name)
        roles[name].write.parquet(paths[name])
    cfg = os.path.join(scratch, "roles.json")
    with open(cfg, "w", encoding="utf-8") as fh:
        json.dump(paths, fh)
    out = os.path.join(scratch, "out")
    assert main(["--roles", cfg, "--out", out, "--as-of", "1998-06-15",
                 "--jobs", "new_peaks,dbd_total", "--create"], spark=spark) == 0
    assert read_section(spark, os.path.join(out, "dbd"), "total").count() == 18
    assert main(["--roles", cfg, "--out", out, "--as-of", "2030-01-01"], spark=spark) == 2
    # fixture thresholds through --params: new_peaks as calibrated (104 rows at sf0.001)
    pj = os.path.join(scratch, "params.json")
    with open(pj, "w", encoding="utf-8") as fh:
        json.dump({"ratio_min": 20.0, "min_floor": 1.0, "stock_ref_from": "1998-05-25",
                   "ppm_types": ["PD", "ND", "ZK", "ZR", "ZC", "ZD", "NO_PPM"]}, fh)
    assert main(["--roles", cfg, "--out", out, "--as-of", "1998-06-15", "--params", pj,
                 "--jobs", "new_peaks"], spark=spark) == 0
    assert read_section(spark, os.path.join(out, "new_peaks"), "data").count() == 104


def test_cli_explain_writes_nothing(spark, scratch, capsys):
    import json

    from demandlens.__main__ import main
    roles = derive(spark, SF0001)
    paths = {}
    for name in ("forecast", "product_dict", "assortment"):
        paths[name] = os.path.join(scratch, "roles", name)
        roles[name].write.parquet(paths[name])
    cfg = os.path.join(scratch, "roles.json")
    with open(cfg, "w", encoding="utf-8") as fh:
        json.dump(paths, fh)
    out = os.path.join(scratch, "out")
    assert main(["--roles", cfg, "--out", out, "--as-of", "1998-06-15", "--jobs", "new_peaks",
                 "--explain"], spark=spark) == 0
    printed = capsys.readouterr().out
    assert "== new_peaks ==" in printed and "Physical Plan" in printed
    assert not os.path.exists(out)


def test_params_from_dict_rejects_unknown():
    from demandlens.params import Params
    with pytest.raises(ValueError):
        Params.from_dict({"as_of": "2024-01-01", "no_such_threshold": 1})
    p = Params.from_dict({"as_of": "2024-01-01", "az_excluded": ["ND", "XX"]})
    assert p.as_of == date(2024, 1, 1) and p.az_excluded == ("ND", "XX")


def test_history_snapshots_pruned(spark, scratch):
    """system_antipeaks reads history snapshots and today's only (not every snapshot)."""
    roles = derive(spark, SF0001)
    p = FIXTURE_PARAMS
    path = os.path.join(scratch, "forecast_hist")
    (roles["forecast"].where(F.col("snapshot_date") >= F.lit(p.as_of - timedelta(days=40)))
     .write.partitionBy("snapshot_date").parquet(path))
    loaded = dict(roles)
    loaded["forecast"] = load(spark, {"forecast": path})["forecast"]
    df = jobs.system_antipeaks(loaded, p)
    plan = df._jdf.queryExecution().executedPlan().toString()
    part_filters = [seg.split("]")[0] for seg in plan.split("PartitionFilters: [")[1:]]
    assert any(str(p.history_from) in f and "snapshot_date" in f for f in part_filters), part_filters
    rows = sorted(map(tuple, df.collect()))
    assert rows == sorted(map(tuple, jobs.system_antipeaks(roles, p).collect()))


def test_sales_sections_share_one_read(spark, scratch):
    roles = derive(spark, SF0001)
    both = jobs.dbd_both(roles, FIXTURE_PARAMS)
    for kind, fn in (("total", jobs.dbd_total), ("reg", jobs.dbd_reg)):
        a = sorted(map(tuple, both.where(F.col("section") == kind).drop("section").collect()), key=str)
        b = sorted(map(tuple, fn(roles, FIXTURE_PARAMS).collect()), key=str)
        assert a == b, kind
    both.collect()
    plan = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_load_catalog_table_conformed(spark):
    raw = spark.createDataFrame([("20260119", "1", " S1 ", 5.0, None)],
                                "CALC_DATE string, PLU string, zavod string, sc_quantity double, "
                                "sc_quantity_not_anypromo double")
    raw.createOrReplaceTempView("raw_daily_sales_view")
    got = load(spark, {"daily_sales": "raw_daily_sales_view"}, raw=True)["daily_sales"]
    assert got.schema == SCHEMAS["daily_sales"]
    r = got.first()
    assert (r.calc_date, r.plu, r.zavod, r.sc_quantity_not_anypromo) == (date(2026, 1, 19), "1", " S1", None)


# --- SURVEY 1.3: column order is part of the report contract ---------------------------------

PRODUCT = ["manager", "name", "node_2", "node_2_name", "node_3", "node_3_name", "node_4",
           "node_4_name", "node_5", "node_5_name"]
NODES = PRODUCT[2:]
EXPECTED_COLUMNS = {
    "current_snapshot": ["current_snapshot_exists"],
    "system_antipeaks": PRODUCT + ["material", "forecast_date", "total_forecast", "promo_exists",
                                   "PD", "ND", "ZK", "ZR", "ZC", "ZD", "NO_PPM",
                                   "median_forecast", "ratio"],
    "old_peaks": ["manager", "name", "sku", "store"] + NODES + [
        "ppm_type", "peak_eve_value", "last_year_sales", "peak_day", "peak_value", "avg_sales",
        "peak_on_weekend", "has_s4_adjustment", "has_car_adjustment", "final_forecast"],
    "new_peaks": PRODUCT + ["az_type", "material", "store", "max_forecast", "min_forecast", "ratio"],
    "antipeaks": ["manager", "name", "material"] + NODES + [
        "forecast_date", "zavod_num", "system_forecast", "car_forecast", "s4_forecast",
        "car_delta", "s4_delta"],
    "dbd_total": ["user", "ui_5", "ui_5_name"] + [f"d{k}" for k in range(14, 0, -1)]
                 + [f"wow_{k}" for k in range(7, 0, -1)] + ["dod", "wow_week"],
}
EXPECTED_COLUMNS["dbd_reg"] = EXPECTED_COLUMNS["dbd_total"]


@pytest.mark.parametrize("job", sorted(EXPECTED_COLUMNS))
def test_report_column_order(spark, job):
    roles = derive(spark, SF0001)
    fn = jobs.gate if job == "current_snapshot" else jobs.JOBS[job][0]
    cols = fn(roles, FIXTURE_PARAMS).columns
    assert cols == EXPECTED_COLUMNS[job]
    assert len(cols) == {"current_snapshot": 1, "system_antipeaks": 23, "old_peaks": 22,
                         "new_peaks": 16, "antipeaks": 18, "dbd_total": 26, "dbd_reg": 26}[job]


def test_preflight_reports_duplicate_dimension_keys(spark):
    from demandlens.plans.run import preflight
    roles = derive(spark, SF0001)
    got = preflight(roles)
    assert got["product_dict"] == 0 and got["store_dict"] == 0 and got["plu_cat"] == 0
    dup = dict(roles)
    dup["product_dict"] = roles["product_dict"].unionByName(
        roles["product_dict"].where(F.col("material").isin("1", "2", "3")))
    assert preflight(dup)["product_dict"] == 3


def test_bucketed_forecast_removes_window_and_aggregate_shuffles(spark, scratch):
    """A forecast table bucketed by (material, store) already has the partitioning the peak
    windows and the max/min aggregate need: no exchange is planned for them."""
    import re
    import uuid

    from demandlens.operators import peaks
    roles = derive(spark, SF0001)
    table = f"forecast_bucketed_{uuid.uuid4().hex[:8]}"
    (roles["forecast"].write.option("path", os.path.join(scratch, table))
     .bucketBy(4, "material", "store").saveAsTable(table))
    bucketed = load(spark, {"forecast": table})["forecast"]
    p = FIXTURE_PARAMS

    def first(f):
        return peaks.first_violation(peaks.spike_violations(
            peaks.neighbours(peaks.peak_series(f, p)), p))

    def shuffles(df):
        return re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution()
                          .executedPlan().toString())

    assert shuffles(first(bucketed)) == []
    assert shuffles(peaks.series_min_max_ratio(bucketed, p)) == []
    # the cut job's per-(day, SKU, store) pre-aggregate needs no exchange either
    from demandlens.operators import cuts
    plan = cuts.adjusted_daily(bucketed, roles["store_dict"], roles["assortment"], p)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(forecast_date#\d+, material#\d+L?, store#", plan)
    assert sorted(map(tuple, first(bucketed).collect())) == \
        sorted(map(tuple, first(roles["forecast"]).collect()))
