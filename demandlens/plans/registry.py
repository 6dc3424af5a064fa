"""Named queries over the test tables: operator stages first, whole jobs after.

Each entry takes ``(spark, sf_dir)`` and derives the role tables from the raw test tables in
``sf_dir`` with Spark, so its work grows with them. Parameters are the calibrated fixture
values (``sources.testdata.FIXTURE_PARAMS``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.functions.predicates import store_kept
from demandlens.operators import antipeaks as ap
from demandlens.operators import cuts, enrich, forecast, peaks, sales, stock
from demandlens.plans import daily, jobs
from demandlens.plans.stage import roles_of, stage, with_candidates
from demandlens.session import scratch_folder
from demandlens.sinks.report import read_section, write_section
from demandlens.sources.testdata import FIXTURE_PARAMS, derive

P = FIXTURE_PARAMS
Query = Callable[[SparkSession, str], DataFrame]


def _q(body: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    """Wrap a job body as a ``(spark, sf_dir)`` query; the plan is built on every call.

    Exact decimals become doubles in the result, the type that both engines share.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_doubles(body(derive(spark, sf_dir, P.as_of)))
    run.__doc__ = body.__doc__
    return run


def as_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _sap_input(r):
    return jobs.system_antipeaks_input(r, P)


def _peak_first(r):
    nb = peaks.neighbours(peaks.peak_series(r["forecast"], P))
    return peaks.first_violation(peaks.spike_violations(nb, P))


def _peak_recent(r):
    ly = peaks.last_year_sales(_peak_first(r), r["sales_stock"], P)
    return peaks.recent_sales_by_type(ly, r["sales_stock"], P)


def _cut_deltas(r):
    return cuts.adjustment_deltas(
        cuts.adjusted_daily(r["forecast"], r["store_dict"], r["assortment"], P))


def _dbd_args(r):
    return r["daily_sales"], r["plu_cat"], r["user_login"], P


FORECAST_KEYS = ("material", "store", "forecast_date", "snapshot_date", "system_forecast")

BODIES: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    # --- projections, filters, predicates
    "promo_flag_rows": lambda r: forecast.horizon_rows(r["forecast"], P),
    "store_exclusion_contains": lambda r: r["forecast"].where(
        store_kept("store", contains=P.antipeak_store_substring)).select(*FORECAST_KEYS),
    "store_exclusion_list": lambda r: r["forecast"].where(
        store_kept("store", ids=P.peak_store_list)).select(*FORECAST_KEYS),
    "store_exclusion_prefix": lambda r: r["daily_sales"].where(
        store_kept("zavod", prefixes=P.sales_store_prefixes))
        .select("calc_date", "plu", "zavod", "sc_quantity"),
    "horizon_filter": lambda r: forecast.current_horizon(r["forecast"], P)
                         .select("material", "store", "forecast_date", "diag_id", "system_forecast"),
    "actualised_history": lambda r: forecast.history_rows(r["forecast"], P),
    # --- system antipeaks stages
    "daily_totals": lambda r: forecast.daily_totals(forecast.horizon_rows(r["forecast"], P)),
    "stitched_totals": lambda r: forecast.stitched_totals(r["forecast"], P),
    "ppm_counts": lambda r: stock.ppm_counts(r["sales_stock"], P),
    "ppm_pivot": lambda r: stock.ppm_pivot(r["sales_stock"], P),
    "product_enriched": lambda r: enrich.with_product(
        forecast.stitched_totals(r["forecast"], P), r["product_dict"]),
    "ppm_left_joined": _sap_input,
    "promo_free_median": lambda r: ap.promo_free_median(_sap_input(r), P),
    "median_attached": lambda r: ap.with_median(_sap_input(r), P),
    "antipeak_candidates": lambda r: ap.candidates(ap.with_median(_sap_input(r), P), P),
    "min_ratio_per_sku": lambda r: ap.min_ratio_per_sku(
        ap.candidates(ap.with_median(_sap_input(r), P), P))
        .select("material", "forecast_date", "total_forecast", "median_forecast", "ratio"),
    # --- old peaks stages
    "series_neighbours": lambda r: peaks.neighbours(peaks.peak_series(r["forecast"], P)),
    "spike_violations": lambda r: peaks.spike_violations(
        peaks.neighbours(peaks.peak_series(r["forecast"], P)), P),
    "first_violation": _peak_first,
    "last_year_sales": lambda r: peaks.last_year_sales(_peak_first(r), r["sales_stock"], P),
    "recent_sales_by_type": _peak_recent,
    "peak_rejoin_flags": lambda r: peaks.peak_rejoin_flags(_peak_recent(r), r["forecast"], P),
    # --- new peaks stages
    "series_min_max_ratio": lambda r: peaks.series_min_max_ratio(r["forecast"], P),
    "assortment_type_lookup": lambda r: peaks.with_assortment_type(
        peaks.series_min_max_ratio(r["forecast"], P), r["assortment"]),
    # --- adjustment cut stages
    "allowed_assortment": lambda r: cuts.allowed_assortment(r["assortment"], P),
    "store_format_filter": lambda r: cuts.store_format_filter(r["forecast"], r["store_dict"], P),
    "adjusted_daily": lambda r: cuts.adjusted_daily(r["forecast"], r["store_dict"],
                                                       r["assortment"], P),
    "adjustment_deltas": _cut_deltas,
    "adjustment_cuts": lambda r: cuts.adjustment_cuts(_cut_deltas(r), P),
    # --- day-by-day sales stages
    "sales_by_category_day": lambda r: sales.sales_by_category_day(*_dbd_args(r)),
    "day_matrix": lambda r: sales.day_matrix(*_dbd_args(r)),
    "growth_rates": lambda r: sales.growth_rates(*_dbd_args(r)),
    "matrix_total_row": lambda r: sales.total_row(sales.report_rows(*_dbd_args(r)), P),
    # --- whole jobs
    "current_snapshot": lambda r: jobs.gate(r, P),
    "system_antipeaks": lambda r: jobs.system_antipeaks(r, P),
    "old_peaks": lambda r: jobs.old_peaks(r, P),
    "new_peaks": lambda r: jobs.new_peaks(r, P),
    "antipeaks": lambda r: jobs.antipeaks(r, P),
    "dbd_total": lambda r: jobs.dbd_total(r, P),
    "dbd_reg": lambda r: jobs.dbd_reg(r, P),
    # both sales sections from one read
    "dbd_sections": lambda r: jobs.dbd_both(r, P),
}

# --- the batch's mechanisms: the same rows by way of staged inputs, daily partials or a section ---

def staged_job(name: str) -> Query:
    """A job over inputs that were staged in one pass each, as the batch runs it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_folder(spark, "staged")
        staged = stage(derive(spark, sf_dir, P.as_of), P, folder, roles_of([name]))
        if name == "old_peaks":
            staged = with_candidates(staged, P)
        return as_doubles(jobs.JOBS[name][0](staged, P))
    return run


def daily_job(name: str, kind: str) -> Query:
    """A job over daily partials. A first batch, a day earlier, reads its whole window; the
    second reads the one day that is new and one that is replayed."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_folder(spark, "daily")
        roles = derive(spark, sf_dir, P.as_of)
        daily.refresh(spark, roles, P.replace(as_of=P.day(1)), folder, kind)
        daily.refresh(spark, roles, P, folder, kind, again=[P.day(5)])
        kept = {**roles, daily.KINDS[kind][1]: daily.partial(spark, P, folder, kind)}
        return as_doubles(jobs.JOBS[name][0](kept, P))
    return run


def written_job(name: str) -> Query:
    """A job's section, replaced once and read back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_folder(spark, "report")
        df = jobs.JOBS[name][0](derive(spark, sf_dir, P.as_of), P)
        write_section(df.limit(0), path, "data", must_exist=False)
        write_section(df, path, "data")
        return as_doubles(read_section(spark, path, "data"))
    return run


MECHANISMS: dict[str, tuple[Query, str]] = {        # query, and the job whose rows it gives
    "staged_system_antipeaks": (staged_job("system_antipeaks"), "system_antipeaks"),
    "staged_old_peaks": (staged_job("old_peaks"), "old_peaks"),
    "staged_new_peaks": (staged_job("new_peaks"), "new_peaks"),
    "staged_antipeaks": (staged_job("antipeaks"), "antipeaks"),
    "staged_dbd_reg": (staged_job("dbd_reg"), "dbd_reg"),
    "daily_system_antipeaks": (daily_job("system_antipeaks", "history"), "system_antipeaks"),
    "daily_dbd_total": (daily_job("dbd_total", "sales"), "dbd_total"),
    "section_dbd_reg": (written_job("dbd_reg"), "dbd_reg"),
}

# registered queries: each body over the roles derived from the test tables in ``sf_dir``
QUERIES: dict[str, Query] = {**{name: _q(body) for name, body in BODIES.items()},
                             **{name: query for name, (query, _) in MECHANISMS.items()}}

PIPELINES = ("current_snapshot", "system_antipeaks", "old_peaks", "new_peaks", "antipeaks",
             "dbd_total", "dbd_reg")
