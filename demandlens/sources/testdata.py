"""Role tables derived by Spark from the TPC-H-like test tables.

The monitored system's own warehouse is not available, so every role is a lazy DataFrame
computed from ``lineitem``, ``part`` and ``supplier``. Products are the parts, so products,
stores, forecast and stock rows all grow with those tables. The lines are spread by their keys over
the days around ``as_of`` (and the same days a year earlier), so that a series has as many
days at any scale. The rules below are the fixture contract (FIXTURES.md section 3); the
oracle SQL in ``oracle/roles.py`` spells out the same rules for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.params import Params
from demandlens.sources.roles import MEASURE, project

AS_OF = date(1998, 6, 15)

# Thresholds calibrated so that every job returns rows on the test tables (FIXTURES.md section 4).
FIXTURE_PARAMS = Params(
    as_of=AS_OF,
    stock_ref_from=date(1998, 5, 25),   # as_of - 21
    stock_ref_to=date(1998, 6, 14),     # as_of - 1
    min_median=40.0, antipeak_ratio=0.4, peak_floor=20.0, min_abs_rise=10.0, min_ly_gap=0.5,
    ratio_min=20.0, max_floor=10.0, min_floor=1.0, day_total_floor=60.0, min_stores=1,
    cut_pct=-50.0,
)

# --- fixed values of the fixture derivation -----------------------------------------------
DAYS, FIRST_DAY = 40, -16        # lines fall on the days as_of - 16 to as_of + 23
PARTS_PER_STORE = 50             # consecutive parts share a store; each part is in two
DISMM_BY_H8 = ("PD", "ND", "ZK", "ZR", "ZC", "ZD", "XX", None)   # index = h % 8
# ------------------------------------------------------------------------------------------


def _store(number: Column) -> Column:
    return (F.when(number % 10 == 9, F.concat(F.lit("L00"), (number % 3 + 1).cast("string")))
             .otherwise(F.concat(F.lit("S"), number.cast("string"))))


def _zavod(suppkey: Column) -> Column:
    return (F.when(suppkey % 10 == 9, F.lit("L00"))
             .when(suppkey % 10 == 8, F.lit("R00"))
             .when(suppkey % 10 == 7, F.lit("B00"))
             .otherwise(F.concat(F.lit("S"), (suppkey % 7).cast("string"))))


def _h(part: Column, number: Column) -> Column:
    return part + number


def _dismm(h: Column) -> Column:
    k = h % 8
    expr = F.lit(None).cast("string")
    for i, code in enumerate(DISMM_BY_H8):
        if code is not None:
            expr = F.when(k == i, F.lit(code)).otherwise(expr)
    return expr


def _quantity(column: str = "l_quantity") -> Column:
    """Whole pieces and a fraction by line number, as an exact decimal."""
    return (F.col(column).cast("decimal(18,3)")
            + (F.col("l_linenumber") * 37).cast("decimal(18,3)") / F.lit(1000)).cast("decimal(18,3)")


def _lines(lineitem: DataFrame, as_of: date) -> DataFrame:
    ok, ln, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    number = F.floor(part / PARTS_PER_STORE) + ln % 2
    return lineitem.select(
        part.cast("string").alias("material"), part.alias("part"), number.alias("number"),
        _store(number).alias("store"),
        F.date_add(F.lit(as_of), (FIRST_DAY + (ok * 7 + ln * 11) % DAYS).cast("int")).alias("d"),
        _quantity().alias("q"), ok.alias("ok"), ln.alias("ln"),
        (ok % 50 == 1).alias("promo"),
    )


class LazyRoles(Mapping):
    """Role name -> DataFrame, each plan built on first access.

    Plans live as long as this mapping, which is one call of ``derive``: the next call lists
    the files anew. A job that needs three roles does not pay for building the other five.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, role: str) -> DataFrame:
        if role not in self._built:
            self._built[role] = self._builders[role]()
        return self._built[role]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def derive(spark: SparkSession, sf_dir: str, as_of: date = AS_OF) -> LazyRoles:
    """The eight role frames derived from the test tables in ``sf_dir``."""
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def lines() -> DataFrame:
        return _lines(read("lineitem"), as_of)

    zero = F.lit(Decimal(0))
    q, ln = F.col("q"), F.col("ln")

    def forecast() -> DataFrame:
        return (
            lines().groupBy(
                "material", "store",
                F.col("d").alias("forecast_date"),
                F.least(F.col("d"), F.lit(as_of)).alias("snapshot_date"),
                F.when(F.col("ok") % 20 == 0, F.lit("D1")).otherwise(F.lit("")).alias("diag_id"),
                F.when(F.col("promo"), F.lit("P1")).otherwise(F.lit("")).alias("ofr_id"),
                F.col("promo").cast("int").alias("promo_flag"))
            .agg(F.sum(q).alias("system_forecast"),
                 F.sum(F.when(ln.isin(2, 6, 7), F.lit(Decimal("-0.75")) * q)).cast(MEASURE)
                  .alias("s4_adjustment"),
                 F.sum(F.when(ln <= 4, -q)).alias("car_adjustment"))
            .withColumn("approved_forecast",
                        F.col("system_forecast") + F.coalesce("s4_adjustment", zero)
                        + F.coalesce("car_adjustment", zero))
            .transform(lambda df: project(df, "forecast"))
        )

    def sales_stock() -> DataFrame:
        # every line is sold on its day and, a third in full and else a quarter, a year earlier
        before = F.when(F.col("ok") % 3 == 0, q).otherwise(q * F.lit(Decimal("0.25")))
        days = F.array(F.struct(F.col("d").alias("caldate"), q.cast("decimal(20,5)").alias("sold")),
                       F.struct(F.add_months("d", -12).alias("caldate"),
                                before.cast("decimal(20,5)").alias("sold")))
        return (
            lines().withColumn("_on", F.explode(days)).select("*", "_on.caldate", "_on.sold")
            .groupBy("caldate", "material", F.col("store").alias("plant"),
                     F.col("promo").cast("int").alias("ispromo"),
                     _dismm(_h(F.col("part"), F.col("number"))).alias("dismm"))
            .agg(F.sum("sold").alias("sc_quantity"))
            .transform(lambda df: project(df, "sales_stock"))
        )

    def product_dict() -> DataFrame:
        return read("part").select(
            F.col("p_partkey").cast("string").alias("material"),
            F.col("p_brand").alias("manager"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("node_2"),
            F.concat(F.lit("Type "), F.col("p_type")).alias("node_2_name"),
            F.col("p_brand").alias("node_3"),
            F.concat(F.lit("Brand "), F.col("p_brand")).alias("node_3_name"),
            F.concat(F.col("p_type"), F.lit("-"), F.col("p_brand")).alias("node_4"),
            F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand")).alias("node_4_name"),
            F.col("p_partkey").cast("string").alias("node_5"),
            F.col("p_name").alias("node_5_name"),
        )

    def assortment() -> DataFrame:
        return (
            lines().select("part", "material", "number", "store").distinct()
            .select(F.col("material").alias("plu"), F.col("store").alias("zavod"),
                    F.when(_h(F.col("part"), F.col("number")) % 5 == 0, F.lit("ND"))
                     .otherwise(F.lit("AZ")).alias("az_type")).distinct()
        )

    def store_dict() -> DataFrame:
        n = F.col("n")
        numbers = read("part").select(F.explode(F.array(
            F.floor(F.col("p_partkey") / PARTS_PER_STORE),
            F.floor(F.col("p_partkey") / PARTS_PER_STORE) + 1)).alias("n")).distinct()
        return numbers.select(
            _store(n).alias("number"),
            F.when(n % 10 == 9, F.lit("DC")).when(n % 7 < 3, F.lit("Mahalla"))
             .when(n % 7 < 6, F.lit("Supermarket")).otherwise(F.lit("Express")).alias("type_cf"),
        ).distinct()

    def daily_sales() -> DataFrame:
        promo = F.col("l_orderkey") % 50 == 1
        sold = _quantity()
        return (
            read("lineitem").groupBy(F.col("l_shipdate").cast("date").alias("calc_date"),
                                     F.col("l_partkey").cast("string").alias("plu"),
                                     _zavod(F.col("l_suppkey")).alias("zavod"))
            .agg(F.sum(sold).alias("sc_quantity"),
                 F.sum(F.when(promo, zero).otherwise(sold)).alias("sc_quantity_not_anypromo"))
            .transform(lambda df: project(df, "daily_sales"))
        )

    def plu_cat() -> DataFrame:
        return read("part").where(F.col("p_partkey") % 11 != 0).select(
            F.col("p_partkey").cast("string").alias("plu"), F.col("p_brand").alias("km"),
            F.col("p_type").alias("ui_5"), F.col("p_type").alias("ui_5_name"))

    def user_login() -> DataFrame:
        return (read("part").where(~F.col("p_brand").endswith("3")).select("p_brand").distinct()
                .select(F.col("p_brand").alias("category_manager"),
                        F.concat(F.lit("user_"), F.lower("p_brand")).alias("user")))

    return LazyRoles({"forecast": forecast, "sales_stock": sales_stock,
                      "product_dict": product_dict, "assortment": assortment,
                      "store_dict": store_dict, "daily_sales": daily_sales,
                      "plu_cat": plu_cat, "user_login": user_login})
