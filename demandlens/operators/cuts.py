"""Adjustment cuts: SKU days whose forecast is cut by more than half, over many stores
(G7, P10, D1, J8, J9, F2, G8, G9, M12, P17, T1).

The source joins every forecast row to the store dictionary and the de-duplicated assortment,
then counts distinct stores and sums per (day, SKU). Here the forecast is dealt by (SKU, store)
and summed per (day, SKU, store). The two dimensions are joined to each other first,
as multiplicities, i.e. how many store rows and how many assortment rows each key matches.
Each sum becomes a weighted sum and the distinct-store count becomes a row count. That is
exact, fan-out included: a row that the joins would repeat m times is weighted by m. It
avoids the expand-based distinct aggregation, and the joins see one row per (day, SKU,
store) instead of one per offer line.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.functions.measures import adjustment_delta, exact
from demandlens.functions.predicates import between, current, main_line
from demandlens.params import Params
from demandlens.sources.roles import PRODUCT_COLUMNS


def allowed_assortment(assortment: DataFrame, p: Params) -> DataFrame:
    """Distinct (plu, zavod, az_type), excluded types dropped (NULL type too)."""
    return (assortment.where(~F.col("az_type").isin(list(p.az_excluded)))
            .select("plu", "zavod", "az_type").distinct())


def _horizon_lines(forecast: DataFrame, p: Params) -> DataFrame:
    return forecast.where(current("snapshot_date", p.as_of)
                          & (F.col("system_forecast") > 0) & F.col("system_forecast").isNotNull()
                          & between("forecast_date", p.as_of, p.horizon_to)
                          & main_line(null_ok=True))


def store_format_filter(forecast: DataFrame, store_dict: DataFrame, p: Params) -> DataFrame:
    """today's horizon lines of stores of the listed formats, only forecast columns."""
    md = store_dict.where(F.col("type_cf").isin(list(p.store_formats))).select("number")
    f = _horizon_lines(forecast, p)
    return f.join(md, f["store"] == md["number"], "inner").select(*forecast.columns)


def adjusted_daily(forecast: DataFrame, store_dict: DataFrame, assortment: DataFrame,
                   p: Params) -> DataFrame:
    """Per (day, SKU) store count and system / CAR / S4 sums, big days only."""
    zero = F.lit(Decimal(0))
    # dealt by (material, store) once: the per-store sums and the join both use that
    per_store = (_horizon_lines(forecast, p)
                 .select("forecast_date", "material", "store", "system_forecast",
                         "car_adjustment", "s4_adjustment")
                 .repartition("material", "store")
                 .groupBy("forecast_date", "material", "store")
                 .agg(F.sum("system_forecast").alias("s"),
                      F.sum(F.coalesce("car_adjustment", zero)).alias("c"),
                      F.sum(F.coalesce("s4_adjustment", zero)).alias("a")))
    store_w = (store_dict.where(F.col("type_cf").isin(list(p.store_formats)))
               .groupBy("number").agg(F.count(F.lit(1)).alias("ws")))
    assort_w = (allowed_assortment(assortment, p)
                .groupBy("plu", "zavod").agg(F.count(F.lit(1)).alias("wa")))
    # both multiplicities meet on the dimension side, so the forecast joins once
    w = (assort_w.join(store_w, assort_w["zavod"] == store_w["number"], "inner")
         .select("plu", "zavod", "ws", "wa"))
    joined = per_store.join(w, (per_store["material"] == w["plu"])
                            & (per_store["store"] == w["zavod"]), "inner")
    m = F.col("ws") * F.col("wa")
    agg = (joined.groupBy("forecast_date", "material")
           .agg(F.count(F.lit(1)).alias("zavod_num"),
                F.sum(F.col("s") * m).alias("system_forecast"),
                F.sum(F.col("c") * m).alias("car_forecast"),
                F.sum(F.col("a") * m).alias("s4_forecast")))
    return agg.where(F.col("system_forecast") > exact(p.day_total_floor))


def adjustment_deltas(daily: DataFrame) -> DataFrame:
    """Percent change of the day total after each adjustment (0 when there is none)."""
    return daily.select("*",
                        adjustment_delta("system_forecast", "car_forecast").alias("car_delta"),
                        adjustment_delta("system_forecast", "s4_forecast").alias("s4_delta"))


def cut_rule(p: Params) -> Column:
    """Enough stores, and a negative adjustment that cuts more than ``cut_pct``."""
    cut = F.lit(p.cut_pct)
    return ((F.col("zavod_num") > F.lit(p.min_stores))
            & (((F.col("car_forecast") < 0) & (F.col("car_delta") < cut))
               | ((F.col("s4_forecast") < 0) & (F.col("s4_delta") < cut))))


CUT_COLUMNS = ("forecast_date", "zavod_num", "system_forecast", "car_forecast", "s4_forecast",
               "car_delta", "s4_delta")


def adjustment_cuts(deltas: DataFrame, p: Params) -> DataFrame:
    """The cut days."""
    return deltas.where(cut_rule(p)).select("material", *CUT_COLUMNS)


def with_product_cuts(cuts: DataFrame, product_dict: DataFrame) -> DataFrame:
    pd = product_dict.withColumnRenamed("material", "_pd_material")
    joined = cuts.join(pd, cuts["material"] == pd["_pd_material"], "inner")
    return joined.select("manager", "name", "material", *PRODUCT_COLUMNS[2:], *CUT_COLUMNS)
