"""Stores per replenishment (PPM) type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.functions.predicates import between
from demandlens.params import Params


def _ppm_type(p: Params):
    return F.coalesce(F.col("dismm"), F.lit(p.ppm_default))


def ppm_counts(sales_stock: DataFrame, p: Params) -> DataFrame:
    """Distinct plants per (material, PPM type) on the stock reference day(s)."""
    return (sales_stock.where(between("caldate", p.stock_from, p.stock_to))
            .groupBy("material", _ppm_type(p).alias("ppm_type"))
            .agg(F.countDistinct("plant").alias("num_of_stores")))


def ppm_pivot(sales_stock: DataFrame, p: Params) -> DataFrame:
    """One row per material, one column per listed PPM type, 0 where absent.

    Types outside the list are ignored, but a material that has only such types still gets
    its row of zeros. Written as (material, type, plant) de-duplication followed by one
    conditional count per listed type: two shuffles, both with map-side partial aggregation,
    and a hot material is spread over plants in the first one.
    """
    plants = (sales_stock.where(between("caldate", p.stock_from, p.stock_to))
              .select("material", _ppm_type(p).alias("ppm_type"), "plant").distinct())
    t = F.col("ppm_type")
    return plants.groupBy("material").agg(
        *[F.count(F.when(t == F.lit(code), F.col("plant"))).alias(code) for code in p.ppm_types])
