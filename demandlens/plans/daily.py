"""Daily partials: history and sales sums that are kept from day to day.

A batch needs 14 past days, of which 13 were read by the batch before. Two partials hold what a
past day contributes, one row per product:

* ``history``: of the snapshot of day D, the totals forecast for D itself and whether a line of
  them was a promotion (G1); the snapshot alone decides them;
* ``sales``: of day D, the sums of both sales measures (the inner sum of G10).

Each day is a section of a report folder (``sinks.report``): replaced whole, in one step, so a day
that is loaded again or replayed after a failure counts once, and a reader never sees half a day.
``refresh`` reads the source for days that are missing or named, each pruned to its own day, and
drops the days that have left the window. Measures are exact decimals, so what the jobs make of the
partials equals what they make of the source, bit for bit.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.functions.predicates import actualised, current, main_line, promo_flag, store_kept
from demandlens.operators.forecast import daily_totals
from demandlens.operators.sales import MEASURES
from demandlens.params import Params
from demandlens.sinks.report import POSITION, current_version, drop_section, sections, write_section


def history_day(roles: Mapping[str, DataFrame], p: Params, day: date) -> DataFrame:
    """Totals of the forecast made on ``day`` for that day."""
    rows = roles["forecast"].where(
        current("snapshot_date", day) & current("forecast_date", day) & actualised()
        & main_line() & store_kept(contains=p.antipeak_store_substring))
    return daily_totals(rows.select("material", "forecast_date", promo_flag().alias("promo_flag"),
                                    "system_forecast"))


def sales_day(roles: Mapping[str, DataFrame], p: Params, day: date) -> DataFrame:
    """Sums of both sales measures per plu on ``day``."""
    rows = roles["daily_sales"].where(current("calc_date", day)
                                      & store_kept("zavod", prefixes=p.sales_store_prefixes))
    return rows.groupBy("calc_date", "plu").agg(*[F.sum(m).alias(m) for m in MEASURES.values()])


# kind -> (what a day contributes, the role that jobs find it under)
KINDS = {"history": (history_day, "history_totals"), "sales": (sales_day, "sales_per_plu")}


def window(p: Params) -> list[date]:
    """The past days of a batch, oldest first."""
    return [p.history_from + timedelta(days=k) for k in range(p.history_days)]


def refresh(spark: SparkSession, roles: Mapping[str, DataFrame], p: Params, folder: str,
            kind: str, again: Iterable[date] = ()) -> list[date]:
    """Bring the partial up to the window of ``p``; returns the days that were read.

    ``again`` names days of the window to read once more (their source was loaded anew).
    """
    compute, _ = KINDS[kind]
    path = f"{folder}/{kind}"
    held = set(sections(spark, path))
    wanted = {d.isoformat(): d for d in window(p)}
    for old in sorted(held - set(wanted)):
        if old < min(wanted):
            drop_section(spark, path, old)
    named = {d.isoformat() for d in again}
    read = [wanted[d] for d in wanted if d not in held or d in named]
    for day in read:
        write_section(compute(roles, p, day), path, day.isoformat(), must_exist=False)
    return read


def partial(spark: SparkSession, p: Params, folder: str, kind: str) -> DataFrame:
    """The rows of the window, read from their days."""
    days = window(p)
    found = [current_version(spark, f"{folder}/{kind}", d.isoformat()) for d in days]
    missing = [d.isoformat() for d, v in zip(days, found) if v is None]
    if missing:
        raise FileNotFoundError(f"{kind} has no day {', '.join(missing)}")
    return spark.read.parquet(*found).drop(POSITION)


def with_partials(spark: SparkSession, roles: Mapping[str, DataFrame], p: Params, folder: str,
                  kinds: Iterable[str] = tuple(KINDS)) -> dict[str, DataFrame]:
    """``roles`` with the partials that the jobs look for, brought up to date."""
    out = {role: roles[role] for role in roles}
    for kind in kinds:
        refresh(spark, roles, p, folder, kind)
        out[KINDS[kind][1]] = partial(spark, p, folder, kind)
    return out
