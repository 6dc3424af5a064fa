"""Dimension lookups.

No join here carries a broadcast hint. The dictionaries are small in practice, and Spark
broadcasts them when its size statistics, or AQE's measured shuffle sizes, are under
``spark.sql.autoBroadcastJoinThreshold``. Otherwise it uses a sort-merge join. A dictionary
that grows past the threshold therefore never reaches a driver-side broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.sources.roles import PRODUCT_COLUMNS


def with_product(df: DataFrame, product_dict: DataFrame, key: str = "material") -> DataFrame:
    """Inner join on the product dictionary, product columns first.

    SKUs missing from the dictionary are dropped, and duplicate dictionary keys fan out.
    ``sources.roles.assert_unique`` checks for that.
    """
    pd = product_dict.withColumnRenamed("material", "_pd_material")
    joined = df.join(pd, df[key] == pd["_pd_material"], "inner")
    return joined.select(*PRODUCT_COLUMNS, *df.columns)


def one_per_material(product_dict: DataFrame) -> DataFrame:
    """One dictionary row per product: of duplicates, the smallest by its columns."""
    return (product_dict.groupBy("material")
            .agg(F.min(F.struct(*PRODUCT_COLUMNS)).alias("_row"))
            .select("material", "_row.*"))


def with_ppm(df: DataFrame, pivot: DataFrame, types) -> DataFrame:
    """Left join of the PPM pivot; a material without stock keeps NULL counts (not 0)."""
    return df.join(pivot, on="material", how="left").select(*df.columns, *types)
