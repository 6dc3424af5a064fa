"""Forecast peaks: day-over-day spikes not explained by last year (old peaks: W1-W6, P13-P15,
J3-J5, G6, F8, F12, F17) and implausibly wide horizons (new peaks: G4, G5, M13, P16, J7).

Scale notes

* The window series is one (material, store) over today's horizon: at most horizon + 1 rows
  per offer line, whatever the table size. Lead, lag and the first-violation row number share
  one ``WindowSpec`` partitioning, so there is one shuffle and one sort. A hot material is spread
  over its stores.
* Ties on ``forecast_date`` inside a series are broken by the value, so a recomputed partition
  (after a lost executor) yields the same neighbours.
* The last-year and recent-sales lookups first cut the stock table to the date range that
  can match. Last year's days are a static range derived from the horizon. Recent sales are
  averaged after the lookup, for the candidates only.
* The lookups join on keys that begin with (material, store), the partitioning of the windows;
  with ``spark.sql.requireAllClusterKeysForCoPartition=false`` (``session.CLUSTER_CONF``) the
  candidates are not shuffled again for them.
* Max and min over the horizon come from one aggregate. Catalyst would keep the reference's
  self-join of two aggregates as two scans and a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlens.functions.measures import exact, nonzero_flag, ratio, weekend_flag, year_before
from demandlens.functions.predicates import between, current, main_line, store_kept
from demandlens.operators.antipeaks import first_per
from demandlens.params import Params
from demandlens.sources.roles import PRODUCT_COLUMNS

SERIES_KEYS = ("material", "store")


# --- old peaks --------------------------------------------------------------------------------

def peak_series(forecast: DataFrame, p: Params) -> DataFrame:
    """Today's promotion-free main-line horizon, listed stores excluded."""
    return (forecast.where(current("snapshot_date", p.as_of)
                           & between("forecast_date", p.as_of, p.horizon_to)
                           & store_kept("store", ids=p.peak_store_list)
                           & (F.col("promo_flag") == 0) & main_line())
            .select("material", "store", "forecast_date", "system_forecast"))


def neighbours(series: DataFrame) -> DataFrame:
    """Next day and value, and the values one and two rows back.

    Neighbours are rows, not calendar days: a removed promotion day is skipped over.
    """
    w = Window.partitionBy(*SERIES_KEYS).orderBy("forecast_date", "system_forecast")
    v = F.col("system_forecast")
    return series.select(
        "material", "store", "forecast_date", "system_forecast",
        F.lead("forecast_date").over(w).alias("next_date"),
        F.lead(v).over(w).alias("next_forecast"),
        F.lag(v).over(w).alias("prev_forecast"),
        F.lag(v, 2).over(w).alias("prev2_forecast"),
    )


def spike_rule(p: Params) -> Column:
    """1 when the next row jumps.

    If yesterday's value is below ``rise_guard`` x the day before, the jump is measured
    against yesterday's value (``rise_lag1``). Otherwise it is measured against today's value
    (``rise_default``). An unknown guard (first or second row of a series) takes the second
    branch, as a SQL CASE does. Rows without a next value never get here (the floor drops them).
    """
    nxt, cur = F.col("next_forecast"), F.col("system_forecast")
    prev, prev2 = F.col("prev_forecast"), F.col("prev2_forecast")
    one, zero = F.lit(1), F.lit(0)
    return (F.when(prev < exact(p.rise_guard) * prev2,
                   F.when(nxt > prev * exact(p.rise_lag1), one).otherwise(zero))
             .otherwise(F.when(nxt > cur * exact(p.rise_default), one).otherwise(zero)))


def spike_violations(nb: DataFrame, p: Params) -> DataFrame:
    """P14 (floor on both days, applied after the window) and P13."""
    floor = exact(p.peak_floor)
    return (nb.where((F.col("system_forecast") > floor) & (F.col("next_forecast") > floor))
              .select(F.col("material").alias("sku"), "store",
                      F.col("next_date").alias("peak_day"),
                      F.col("next_forecast").alias("peak_value"),
                      F.col("forecast_date").alias("peak_eve_date"),
                      F.col("system_forecast").alias("peak_eve_value"),
                      spike_rule(p).alias("fails_rule")))


def first_violation(violations: DataFrame) -> DataFrame:
    """The earliest failing row per series (value order breaks a date tie, so a
    recomputed partition picks the same row)."""
    failing = violations.where(F.col("fails_rule") == 1)
    return (first_per(failing, ["sku", "store"],
                      [F.col("peak_eve_date").asc(), F.col("peak_eve_value").asc(),
                       F.col("peak_value").asc()])
            .select("sku", "store", "peak_eve_value", "peak_day", "peak_value"))


def last_year_sales(first: DataFrame, sales_stock: DataFrame, p: Params) -> DataFrame:
    """Promotion-free sales on the same day a year before the peak (inner join)."""
    # peak days lie in [as_of, horizon_to], so last year's days lie in the shifted range;
    # a static range the stock scan can prune on
    stock = sales_stock.where(
        (F.col("ispromo") == 0)
        & F.col("caldate").between(year_before(F.lit(p.as_of)), year_before(F.lit(p.horizon_to))))
    stock = stock.select(F.col("material").alias("_m"), F.col("plant").alias("_p"),
                         F.col("caldate").alias("_d"), F.col("sc_quantity").alias("last_year_sales"))
    keyed = first.withColumn("_ly", year_before("peak_day"))
    joined = keyed.join(stock, (keyed["sku"] == stock["_m"]) & (keyed["store"] == stock["_p"])
                        & (keyed["_ly"] == stock["_d"]), "inner")
    return joined.select("sku", "store", "peak_eve_value", "last_year_sales", "peak_day", "peak_value")


def recent_sales_by_type(ly: DataFrame, sales_stock: DataFrame, p: Params) -> DataFrame:
    """Mean promotion-free sales over the stock reference range per PPM type.

    The stock rows of the candidates are looked up first and averaged then, so no mean is
    computed for series that have no candidate. A duplicated candidate counts once: its copies would
    only repeat the rows that the mean is taken over.
    """
    recent = (sales_stock.where(between("caldate", p.stock_from, p.stock_to)
                                & (F.col("ispromo") == 0))
              .select(F.col("material").alias("_m"), F.col("plant").alias("_p"),
                      F.col("dismm").alias("ppm_type"), "sc_quantity"))
    cands = ly.distinct()
    keys = ("sku", "store", "peak_eve_value", "last_year_sales", "peak_day", "peak_value")
    joined = cands.join(recent, (cands["sku"] == recent["_m"])
                        & (cands["store"] == recent["_p"]), "inner")
    return (joined.groupBy(*keys, "ppm_type")
            .agg(F.sum("sc_quantity").alias("_sum"), F.count("sc_quantity").alias("_n"))
            .select(*keys, "ppm_type", ratio("_sum", "_n").alias("avg_sales")))


def significant(p: Params) -> Column:
    """Absolute rise over the previous day, and a clear gap to last year's sales."""
    v = F.col("peak_value")
    return (((v - F.col("peak_eve_value")) > exact(p.min_abs_rise))
            & ((v - F.col("last_year_sales")) > v * exact(p.min_ly_gap)))


def peak_rejoin_flags(recent: DataFrame, forecast: DataFrame, p: Params) -> DataFrame:
    """Back to today's main-line forecast row of the peak (matched on the
    value as well), with weekend and adjustment flags and the approved forecast."""
    u = (forecast.where(current("snapshot_date", p.as_of) & main_line()
                        & between("forecast_date", p.as_of, p.horizon_to))
         .select(F.col("material").alias("_u_material"), F.col("store").alias("_u_store"),
                 F.col("forecast_date").alias("_u_date"), F.col("system_forecast").alias("_u_value"),
                 "s4_adjustment", "car_adjustment", "approved_forecast"))
    sig = recent.where(significant(p))
    joined = sig.join(u, (sig["sku"] == u["_u_material"]) & (sig["store"] == u["_u_store"])
                      & (sig["peak_day"] == u["_u_date"]) & (sig["peak_value"] == u["_u_value"]),
                      "inner")
    return joined.select(
        "sku", "store", "ppm_type", "peak_eve_value", "last_year_sales", "peak_day", "peak_value",
        "avg_sales", weekend_flag("peak_day").alias("peak_on_weekend"),
        nonzero_flag("s4_adjustment").alias("has_s4_adjustment"),
        nonzero_flag("car_adjustment").alias("has_car_adjustment"),
        F.col("approved_forecast").alias("final_forecast"))


OLD_PEAK_COLUMNS = ("manager", "name", "sku", "store", *PRODUCT_COLUMNS[2:], "ppm_type",
                    "peak_eve_value", "last_year_sales", "peak_day", "peak_value", "avg_sales",
                    "peak_on_weekend", "has_s4_adjustment", "has_car_adjustment", "final_forecast")


def with_product_sku(flags: DataFrame, product_dict: DataFrame) -> DataFrame:
    pd = product_dict.withColumnRenamed("material", "_pd_material")
    joined = flags.join(pd, flags["sku"] == pd["_pd_material"], "inner")
    return joined.select(*OLD_PEAK_COLUMNS)


# --- new peaks --------------------------------------------------------------------------------

def series_min_max_ratio(forecast: DataFrame, p: Params) -> DataFrame:
    """max/min of positive main-line horizon values per series, wide ones kept."""
    rows = forecast.where(current("snapshot_date", p.as_of) & main_line()
                          & between("forecast_date", p.as_of, p.horizon_to)
                          & (F.col("system_forecast") > 0))
    mm = rows.groupBy("material", "store").agg(F.max("system_forecast").alias("max_forecast"),
                                               F.min("system_forecast").alias("min_forecast"))
    r = ratio("max_forecast", "min_forecast")
    return (mm.where((r > F.lit(p.ratio_min)) & (F.col("max_forecast") > exact(p.max_floor))
                     & (F.col("min_forecast") > exact(p.min_floor)))
              .select("material", "store", "max_forecast", "min_forecast", r.alias("ratio")))


def with_assortment_type(checking: DataFrame, assortment: DataFrame) -> DataFrame:
    """Assortment type of the series (inner; duplicate assortment rows fan out)."""
    a = assortment.select(F.col("plu").alias("_a_plu"), F.col("zavod").alias("_a_zavod"), "az_type")
    joined = checking.join(a, (checking["material"] == a["_a_plu"])
                           & (checking["store"] == a["_a_zavod"]), "inner")
    return joined.select("az_type", *checking.columns)
