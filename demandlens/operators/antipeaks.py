"""System antipeaks: future daily totals far below the recent promotion-free median
(G14, J12, P18, P20, M14, W7).

The median baseline and the argmin are window functions over ``material``. Both use the same
partitioning, so the frame is shuffled once. A partition holds one material's daily totals:
at most history + horizon days (14 + 22 = 36) rows per dictionary entry. The exact median therefore keeps
a bounded buffer per group, whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlens.functions.measures import ratio
from demandlens.params import Params


def _baseline_value(p: Params):
    """P20: only history days (before ``as_of``) without promotion enter the median."""
    return F.when((F.col("forecast_date") < F.lit(p.as_of)) & (F.col("promo_exists") == 0),
                  F.col("total_forecast").cast("double"))


def promo_free_median(totals: DataFrame, p: Params) -> DataFrame:
    """Exact median (mean of the two middle values) per material, as a grouped result."""
    return (totals.groupBy("material")
                  .agg(F.median(_baseline_value(p)).alias("median_forecast"))
                  .where(F.col("median_forecast").isNotNull()))


def with_median(totals: DataFrame, p: Params) -> DataFrame:
    """Every row with its material's baseline median (NULL when there is none)."""
    w = Window.partitionBy("material")
    return totals.withColumn("median_forecast", F.median(_baseline_value(p)).over(w))


def candidates(with_med: DataFrame, p: Params) -> DataFrame:
    """Promotion-free future days below ``antipeak_ratio`` x median, with the ratio.

    A NULL median or date fails every comparison, so such rows drop out here.
    """
    tot, med = F.col("total_forecast"), F.col("median_forecast")
    keep = ((F.col("promo_exists") == 0) & (F.col("forecast_date") >= F.lit(p.as_of))
            & (tot > 0) & (tot < F.lit(p.antipeak_ratio) * med) & (med > F.lit(p.min_median)))
    return with_med.where(keep).withColumn("ratio", ratio(tot, med))


def first_per(df: DataFrame, keys, order) -> DataFrame:
    """First row per ``keys`` by ``order``. Spark plans ``rn = 1`` as a window group
    limit on both sides of the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def min_ratio_per_sku(cands: DataFrame) -> DataFrame:
    """The day with the smallest ratio per material; the earliest day wins a tie."""
    return first_per(cands, ["material"], [F.col("ratio").asc(), F.col("forecast_date").asc()])
