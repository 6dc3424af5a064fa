"""Forecast slices and daily totals (P1-P11, G1, U1) and the snapshot gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.functions.predicates import (actualised, between, current, main_line,
                                             promo_flag, store_kept)
from demandlens.params import Params


def history_rows(forecast: DataFrame, p: Params) -> DataFrame:
    """Forecasts made on their own day over the history window."""
    # the snapshot bound is implied by the two conditions after it; stated, it lets a forecast
    # table partitioned by snapshot day prune to the 14 history snapshots
    return (forecast.where(between("snapshot_date", p.history_from, p.history_to)
                           & main_line() & store_kept(contains=p.antipeak_store_substring)
                           & actualised() & between("forecast_date", p.history_from, p.history_to))
            .select("material", "forecast_date", promo_flag().alias("promo_flag"),
                    "system_forecast"))


def horizon_rows(forecast: DataFrame, p: Params) -> DataFrame:
    """Today's snapshot over the horizon."""
    return (forecast.where(main_line() & store_kept(contains=p.antipeak_store_substring)
                           & current("snapshot_date", p.as_of)
                           & between("forecast_date", p.as_of, p.horizon_to))
            .select("material", "forecast_date", promo_flag().alias("promo_flag"),
                    "system_forecast"))


def current_horizon(forecast: DataFrame, p: Params) -> DataFrame:
    """Today's snapshot over the horizon, every line."""
    return forecast.where(current("snapshot_date", p.as_of)
                          & between("forecast_date", p.as_of, p.horizon_to))


def daily_totals(rows: DataFrame) -> DataFrame:
    """G1: SKU total per day and whether any line of that day is a promotion."""
    return (rows.groupBy("material", "forecast_date")
                .agg(F.sum("system_forecast").alias("total_forecast"),
                     F.max("promo_flag").alias("promo_exists")))


def stitched_totals(forecast: DataFrame, p: Params) -> DataFrame:
    """U1 in one pass (O8): history and horizon daily totals from a single scan.

    The two slices cover disjoint forecast dates, so one ``groupBy`` over their union equals
    the union of two ``groupBy``s, and the table is read once. The outer date ranges are
    redundant conjuncts (both slices imply them) that Catalyst cannot infer through the OR:
    ``forecast_date`` becomes a pushed scan filter, and ``snapshot_date`` a partition filter
    that keeps the read to the 15 snapshots involved instead of every snapshot ever written.
    """
    past = actualised() & between("forecast_date", p.history_from, p.history_to)
    future = current("snapshot_date", p.as_of) & between("forecast_date", p.as_of, p.horizon_to)
    rows = forecast.where(between("snapshot_date", p.history_from, p.as_of)
                          & between("forecast_date", p.history_from, p.horizon_to)
                          & main_line() & store_kept(contains=p.antipeak_store_substring)
                          & (past | future))
    return daily_totals(rows.select("material", "forecast_date",
                                    promo_flag().alias("promo_flag"), "system_forecast"))


def current_snapshot(forecast: DataFrame, p: Params) -> DataFrame:
    """One row, 1 when today's main-line snapshot holds a non-zero forecast, else 0.

    ``limit(1)`` lets every scan task stop at its first hit; the count over at most one row
    always yields exactly one output row.
    """
    hit = forecast.where(current("snapshot_date", p.as_of) & main_line()
                         & (F.col("system_forecast") != 0)).select("material").limit(1)
    return hit.agg(F.count(F.lit(1)).cast("int").alias("current_snapshot_exists"))
