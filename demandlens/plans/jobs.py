"""The monitoring jobs. Each is a pure function of the role frames and one
``Params``, and returns a lazy DataFrame; nothing is collected."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.functions.measures import exact
from demandlens.functions.predicates import between
from demandlens.operators import antipeaks as ap
from demandlens.operators import cuts, enrich, peaks, sales, stock
from demandlens.operators.forecast import (current_snapshot, daily_totals, horizon_rows,
                                             stitched_totals)
from demandlens.params import Params
from demandlens.sources.roles import PRODUCT_COLUMNS

Roles = Mapping[str, DataFrame]


def gate(roles: Roles, p: Params) -> DataFrame:
    """Q-gate: one row, ``current_snapshot_exists`` 1 or 0."""
    return current_snapshot(roles["forecast"], p)


def system_antipeaks_input(roles: Roles, p: Params) -> DataFrame:
    """Daily SKU totals (history + horizon) with product columns and PPM store counts."""
    totals = stitched_totals(roles["forecast"], p)
    with_pd = enrich.with_product(totals, roles["product_dict"])
    return enrich.with_ppm(with_pd, stock.ppm_pivot(roles["sales_stock"], p), p.ppm_types)


def system_antipeaks(roles: Roles, p: Params, ordered: bool = True) -> DataFrame:
    """Q-sap: per SKU, the future day furthest below its promotion-free median.

    Product texts and store counts join the one row that is left per SKU, not the totals that
    go through the median. A SKU of several dictionary rows has each of its totals repeated
    alike, which moves neither the median nor the smallest ratio, so one row of them is used.
    Where the roles have ``history_totals`` (``plans.daily``), the history is not read again.
    """
    kept = roles.get("history_totals")
    totals = (stitched_totals(roles["forecast"], p) if kept is None
              else daily_totals(horizon_rows(roles["forecast"], p)).unionByName(
                  kept.where(between("forecast_date", p.history_from, p.history_to))))
    best = ap.min_ratio_per_sku(ap.candidates(ap.with_median(totals, p), p))
    named = enrich.with_product(best, enrich.one_per_material(roles["product_dict"]))
    out = enrich.with_ppm(named, stock.ppm_pivot(roles["sales_stock"], p), p.ppm_types).select(
        *PRODUCT_COLUMNS, *totals.columns, *p.ppm_types, "median_forecast", "ratio")
    return out.orderBy("material") if ordered else out


def peak_candidates(roles: Roles, p: Params) -> DataFrame:
    """The first spike per series (W1-W6, P13, P14): few rows of a whole snapshot."""
    series = peaks.peak_series(roles["forecast"], p)
    return peaks.first_violation(peaks.spike_violations(peaks.neighbours(series), p))


def old_peaks(roles: Roles, p: Params) -> DataFrame:
    """Q-old: first spike per series that last year's sales do not explain.

    What makes a peak significant is known once last year's sales are, so the few that are
    left go on to the stock and forecast lookups.

    Where the roles have ``peak_candidates`` (``plans.stage.with_candidates``), the candidates are
    a small table, and Spark can make a Bloom filter of their keys for the scan of the stock: it
    does so for a side that it knows to be small and sees a condition on. The floor is such a
    condition; all candidates meet it (P14).
    """
    f, st = roles["forecast"], roles["sales_stock"]
    first = roles.get("peak_candidates")
    first = (peak_candidates(roles, p) if first is None
             else first.where(F.col("peak_value") > exact(p.peak_floor)))
    clear = peaks.last_year_sales(first, st, p).where(peaks.significant(p))
    recent = peaks.recent_sales_by_type(clear, st, p)
    return peaks.with_product_sku(peaks.peak_rejoin_flags(recent, f, p), roles["product_dict"])


def new_peaks(roles: Roles, p: Params) -> DataFrame:
    """Q-new: series whose horizon max/min ratio is implausibly wide.

    The assortment joins first: it shares the series' partitioning by (material, store).
    """
    checking = peaks.series_min_max_ratio(roles["forecast"], p)
    typed = peaks.with_assortment_type(checking, roles["assortment"])
    return enrich.with_product(typed, roles["product_dict"]).select(
        *PRODUCT_COLUMNS, "az_type", *checking.columns)


def antipeaks(roles: Roles, p: Params, ordered: bool = True) -> DataFrame:
    """Q-cut: SKU days cut by more than half through manual adjustments."""
    daily = cuts.adjusted_daily(roles["forecast"], roles["store_dict"], roles["assortment"], p)
    out = cuts.with_product_cuts(cuts.adjustment_cuts(cuts.adjustment_deltas(daily), p),
                                 roles["product_dict"])
    return out.orderBy("forecast_date", "material") if ordered else out


def dbd(roles: Roles, p: Params, kind: str = "total", ordered: bool = True) -> DataFrame:
    """Q-dbd: 14-day sales matrix, growth rates and total row; ``kind`` is total or reg.

    Where the roles have ``sales_per_plu`` (sums per day and plu inside the window, staged or
    kept by ``plans.daily``), the sales themselves are not read.
    """
    kept = roles.get("sales_per_plu")
    if kept is not None:
        kept = kept.where(between("calc_date", p.history_from, p.history_to))
    return sales.dbd_report(roles["daily_sales"] if kept is None else None, roles["plu_cat"],
                            roles["user_login"], p, measure=sales.MEASURES[kind],
                            ordered=ordered, per_plu=kept)


def dbd_both(roles: Roles, p: Params) -> DataFrame:
    """Both sales reports with a ``section`` column (reg, total), from one read of the sales."""
    return sales.dbd_sections(roles["daily_sales"], roles["plu_cat"], roles["user_login"], p)


def dbd_total(roles: Roles, p: Params, ordered: bool = True) -> DataFrame:
    return dbd(roles, p, "total", ordered)


def dbd_reg(roles: Roles, p: Params, ordered: bool = True) -> DataFrame:
    return dbd(roles, p, "reg", ordered)


# Batch order and report targets: job -> (workbook, section)
JOBS: dict[str, tuple[Callable[[Roles, Params], DataFrame], str, str]] = {
    "system_antipeaks": (system_antipeaks, "system_antipeaks", "antipeaks"),
    "old_peaks": (old_peaks, "old_peaks", "data"),
    "new_peaks": (new_peaks, "new_peaks", "data"),
    "antipeaks": (antipeaks, "antipeaks", "antipeaks"),
    "dbd_reg": (dbd_reg, "dbd", "reg"),
    "dbd_total": (dbd_total, "dbd", "total"),
}


def gate_open(roles: Roles, p: Params) -> bool:
    """Driver decision for the batch: the only value ever collected (one row, one int)."""
    return bool(gate(roles, p).first()[0])


__all__ = ["gate", "system_antipeaks", "old_peaks", "new_peaks", "antipeaks", "dbd_total",
           "dbd_reg", "JOBS", "gate_open"]
