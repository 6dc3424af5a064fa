"""Plan-shape invariants: the scale properties the design relies on, checked on the optimised
physical plans, so a refactor that loses one fails here (not only in a 100 TB run)."""

from __future__ import annotations

import re

import pytest

from demandlens.operators import forecast as fc
from demandlens.operators import peaks, sales
from demandlens.plans import jobs
from demandlens.sources.testdata import FIXTURE_PARAMS as P
from demandlens.sources.testdata import derive

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def roles(spark):
    return derive(spark, SF)


def test_sales_pre_aggregated_before_dimension_joins(roles):
    p = plan(jobs.dbd_total(roles, P))
    first_join = max(p.rfind("BroadcastHashJoin"), p.rfind("SortMergeJoin"))
    below = p[first_join:]
    # the sales side of the lowest join is an aggregate keyed by (calc_date, plu)
    assert re.search(r"HashAggregate\(keys=\[calc_date#\d+, plu#\d+L?\]", below)


def test_new_peaks_one_aggregate_for_max_and_min(roles):
    p = plan(peaks.series_min_max_ratio(roles["forecast"], P))
    series_aggs = [ln for ln in p.splitlines()
                   if re.search(r"HashAggregate\(keys=\[material#\d+L?, store#\d+\]", ln)]
    assert len(series_aggs) == 2          # partial + final of one aggregate
    assert all("max(" in ln and "min(" in ln for ln in series_aggs)
    assert "Join" not in p


def test_cuts_have_no_distinct_expansion(roles):
    p = plan(jobs.antipeaks(roles, P))
    assert "Expand" not in p


def test_peak_windows_share_one_exchange(roles):
    nb = peaks.neighbours(peaks.peak_series(roles["forecast"], P))
    p = plan(peaks.first_violation(peaks.spike_violations(nb, P)))
    assert len(re.findall(r"Exchange hashpartitioning\(material#\d+L?, store#\d+, \d+\)", p)) == 1
    assert p.count("Window [") == 2


def test_history_and_horizon_in_one_scan(roles):
    p = plan(fc.stitched_totals(roles["forecast"], P))
    assert p.count("FileScan parquet") == 1
    assert "Union" not in p


def test_median_and_argmin_share_partitioning(roles):
    p = plan(jobs.system_antipeaks(roles, P, ordered=False))
    argmin, median = p.find("Window [row_number"), p.find("Window [percentile")
    assert 0 <= argmin < median
    assert "Exchange" not in p[argmin:median]      # the argmin reuses the median's partitioning


@pytest.mark.parametrize("job", sorted(jobs.JOBS))
def test_scans_read_only_used_columns(roles, job):
    p = plan(jobs.JOBS[job][0](roles, P))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", p):
        cols = {c.split(":")[0] for c in schema.split(",")}
        # lineitem's price, tax, discount, flags and status columns are never used
        assert not cols & {"l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                           "l_linestatus", "p_size", "p_retailprice", "s_name", "s_acctbal"}


@pytest.mark.parametrize("job", sorted(jobs.JOBS))
def test_no_python_udfs_or_cartesian_products(roles, job):
    p = plan(jobs.JOBS[job][0](roles, P))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_sales_report_unions_reuse_the_matrix(spark, roles):
    df = sales.dbd_report(roles["daily_sales"], roles["plu_cat"], roles["user_login"], P)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


# --- the shape for dimensions beyond the broadcast threshold ------------------------------------

@pytest.fixture()
def stored(spark, scratch):
    """Role tables as parquet, read with no broadcast allowed."""
    import os

    from demandlens.sources.roles import load
    paths = {}
    for name, df in derive(spark, SF).items():
        paths[name] = os.path.join(scratch, name)
        df.write.parquet(paths[name])
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield load(spark, paths)
    for k in keys:
        spark.conf.unset(k)


def exchanges(df) -> list[str]:
    return re.findall(r"\bExchange (hashpartitioning\([^\n]*?\), [A-Z_]+)", plan(df))


def test_old_peaks_without_broadcast(stored):
    found = exchanges(jobs.old_peaks(stored, P))
    assert len(found) <= 7, found
    # nothing is dealt by a wider key than (material, store)
    assert not [e for e in found if e.count("#") > 2], found


def test_antipeaks_without_broadcast(stored):
    df = jobs.antipeaks(stored, P, ordered=False)
    found = exchanges(df)
    # the forecast moves by (material, store) once, then as sums per (day, SKU)
    assert not [e for e in found if re.match(r"hashpartitioning\(store#\d+,", e)], found
    assert sum("REPARTITION" in e for e in found) == 1
    assert not [e for e in found if "forecast_date" in e and "store" in e], found


def test_new_peaks_without_broadcast(stored):
    found = exchanges(jobs.new_peaks(stored, P))
    # series and assortment by (material, store), then both sides of the dictionary join
    assert len(found) == 4, found
