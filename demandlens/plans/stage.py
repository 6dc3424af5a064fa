"""Staging: every source table is read once per batch.

The jobs share their inputs: five of seven read today's forecast, two the sales window, three the
stock. ``stage`` writes, per role, the rows and columns that any of the jobs asked for can use,
in one pass over the source, and hands the jobs roles that read those. Large tables shrink on the way:
the forecast to today's horizon and the history made on its own day, the stock to the two date
ranges that are looked up, the sales to sums per (day, plu), from which both sales reports branch.

What a pass can tell about its input is counted while it runs (``DataFrame.observe``), so no count
costs a job: whether today's snapshot is loaded, how often a dimension's key values repeat
(they fan out results), and, where ``load`` observes them, the values that ``conform`` rejected.

Staged roles lie in one folder with a file per role that names the pass's counts, written last: a
batch that is run again takes over the roles that were finished.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.functions.measures import year_before
from demandlens.functions.predicates import actualised, between, current, main_line, store_kept
from demandlens.operators.sales import MEASURES, per_plu_sums
from demandlens.params import Params
from demandlens.plans import jobs
from demandlens.sinks.files import read_json, write_json

# Dimension keys whose duplicates fan out job results. The jobs keep the fan-out,
# as the monitored SQL does; the batch reports it.
DIMENSION_KEYS = {"product_dict": ("material",), "store_dict": ("number",),
                  "plu_cat": ("plu",), "user_login": ("category_manager",),
                  "assortment": ("plu", "zavod")}
JOB_ROLES = {
    "system_antipeaks": ("forecast", "sales_stock", "product_dict"),
    "old_peaks": ("forecast", "sales_stock", "product_dict"),
    "new_peaks": ("forecast", "assortment", "product_dict"),
    "antipeaks": ("forecast", "store_dict", "assortment", "product_dict"),
    "dbd_reg": ("daily_sales", "plu_cat", "user_login"),
    "dbd_total": ("daily_sales", "plu_cat", "user_login"),
}
# staged under another name: sums per (day, plu) take the place of the sales
STAGED_AS = {"daily_sales": "sales_per_plu"}


def roles_of(jobs: Iterable[str]) -> list[str]:
    """Roles that the jobs read, the forecast first: the gate needs it."""
    needed = {role for job in jobs for role in JOB_ROLES[job]}
    return ["forecast", *sorted(needed - {"forecast"})]


def gate_metric(p: Params) -> Column:
    """P12 as a count: today's main-line rows with a forecast."""
    return F.count_if(current("snapshot_date", p.as_of) & main_line()
                      & (F.col("system_forecast") != 0)).alias("gate")


def forecast_rows(p: Params) -> Column:
    """Today's horizon, every line, and the history made on its own day."""
    past = (actualised() & between("forecast_date", p.history_from, p.history_to) & main_line()
            & store_kept(contains=p.antipeak_store_substring))
    future = current("snapshot_date", p.as_of) & between("forecast_date", p.as_of, p.horizon_to)
    return past | future


def stock_slice(sales_stock: DataFrame, p: Params) -> DataFrame:
    """The stock reference range, and last year's promotion-free days of the horizon."""
    year = ((F.col("ispromo") == 0) & F.col("caldate").between(
        year_before(F.lit(p.as_of)), year_before(F.lit(p.horizon_to))))
    return sales_stock.where(between("caldate", p.stock_from, p.stock_to) | year)


def repeated(df: DataFrame, keys: Iterable[str]) -> tuple[DataFrame, Column]:
    """``df`` with a column that numbers the rows of a key, and the count of repeated keys."""
    own = Window.partitionBy(*keys).orderBy(*keys)
    return df.withColumn("_row", F.row_number().over(own)), F.count_if(
        F.col("_row") == 2).alias("repeated_keys")


class Staged(Mapping):
    """Roles read from their staged tables, and what their passes counted."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.schemas: dict[str, T.StructType] = {}
        self.counts: dict[str, dict[str, int]] = {}

    def add(self, name: str, note: dict) -> None:
        self.schemas[name] = T.StructType.fromJson(note["schema"])
        self.counts[name] = note["counts"]

    def __getitem__(self, name: str) -> DataFrame:
        # the schema is given: a partitioned table without rows has no file to take it from
        schema = self.schemas[name]
        return (self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
                .select(*schema.fieldNames()))

    def __iter__(self) -> Iterator[str]:
        return iter(self.schemas)

    def __len__(self) -> int:
        return len(self.schemas)

    @property
    def gate_open(self) -> bool:
        return self.counts["forecast"].get("gate", 0) > 0

    def fan_out(self) -> dict[str, int]:
        """Dimension role -> number of key values that occur more than once."""
        return {r: c["repeated_keys"] for r, c in self.counts.items() if "repeated_keys" in c}

    def rejected(self) -> dict[str, dict[str, int]]:
        """Role -> field -> values that could not be read as the field's type and became NULL."""
        found = {r: {k.removeprefix("rejected_"): v for k, v in c.items()
                     if k.startswith("rejected_") and v} for r, c in self.counts.items()}
        return {r: c for r, c in found.items() if c}


def _plan(role: str, df: DataFrame, p: Params) -> tuple[DataFrame, Observation | None, tuple]:
    """What is written of a role, its observation, and the partition columns."""
    if role == "forecast":
        # the snapshot range reaches the scan; the gate counts above it and below the narrower
        # conditions, since it asks for any forecast day
        window, seen = df.where(between("snapshot_date", p.history_from, p.as_of)), Observation()
        return window.observe(seen, gate_metric(p)).where(forecast_rows(p)), seen, ("snapshot_date",)
    if role == "sales_stock":
        return stock_slice(df, p), None, ("caldate",)
    if role == "daily_sales":
        return per_plu_sums(df, p, list(MEASURES.values())), None, ()
    rows, metric = repeated(df, DIMENSION_KEYS[role])
    seen = Observation()
    return rows.observe(seen, metric).drop("_row"), seen, ()


def stage(roles: Mapping[str, DataFrame], p: Params, folder: str,
          needed: Iterable[str]) -> Staged:
    """Stage the ``needed`` roles in ``folder``; finished ones of an earlier run are taken over."""
    needed = list(needed)
    spark = roles[needed[0]].sparkSession
    out = Staged(spark, folder)
    for role in needed:
        name = STAGED_AS.get(role, role)
        note = read_json(spark, f"{folder}/{name}.json")
        if note is None:
            df, seen, parts = _plan(role, roles[role], p)
            df.write.mode("overwrite").partitionBy(*parts).parquet(f"{folder}/{name}")
            counts = {k: int(v or 0) for k, v in seen.get.items()} if seen else {}
            own = getattr(roles, "observed", {}).get(role)
            if own is not None:
                counts |= own.counts()
            note = {"schema": df.schema.jsonValue(), "counts": counts}
            write_json(spark, f"{folder}/{name}.json", note)
        out.add(name, note)
        if role == "forecast" and not out.gate_open:
            break                        # nothing is going to run
    return out


def with_candidates(staged: Staged, p: Params) -> Staged:
    """``staged`` with the peak candidates as a table of their own, made once.

    The lookups into the stock then join a table whose size is known, not the end of a long plan:
    Spark prunes the stock by a runtime filter on their keys (from the sizes that
    ``spark.sql.optimizer.runtime.bloomFilter.*`` names), without a broadcast of either side.
    """
    name = "peak_candidates"
    if name not in staged:
        note = read_json(staged.spark, f"{staged.folder}/{name}.json")
        if note is None:
            found = jobs.peak_candidates(staged, p)
            found.write.mode("overwrite").parquet(f"{staged.folder}/{name}")
            note = {"schema": found.schema.jsonValue(), "counts": {}}
            write_json(staged.spark, f"{staged.folder}/{name}.json", note)
        staged.add(name, note)
    return staged
