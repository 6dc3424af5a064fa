"""Day-by-day sales report.

For every (user, category) the report has the last 14 daily sums (rounded), the change of each
of the last seven days against the same weekday a week earlier, the change of yesterday against
the day before, the change of the last week against the week before, and a grand-total row.

Plan shape, chosen for scale:

* sales are first summed per (day, plu) after the date and store filters. The partial
  aggregate runs map-side, so a plu that holds a third of all rows leaves each task as at most
  14 rows, and the category/user joins see one row per (day, plu) instead of one per store;
* the two dimension joins are left equi-joins without hints: the category and user tables are
  broadcast when Spark's size statistics (or AQE's runtime sizes) put them under
  ``spark.sql.autoBroadcastJoinThreshold``, and shuffle-joined otherwise;
* all 16 day and week sums come from one hash aggregate (one shuffle on the report key); the
  total row aggregates that result again (a single-row global aggregate over the small report),
  which AQE plans as a reused exchange.

Summing partial sums per (day, plu) and then per report key equals the per-row sums because the
report key is a function of plu (plus the user fan-out, which repeats a partial sum exactly as
it would repeat each row) and SUM skips NULLs the same way at both levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.functions.measures import iso_weekday, pct_change
from demandlens.functions.predicates import between, store_kept
from demandlens.params import Params

REPORT_KEYS = ("user", "ui_5", "ui_5_name")
DAY_COLUMNS = tuple(f"d{k}" for k in range(14, 0, -1))           # d14 ... d1
WOW_COLUMNS = tuple(f"wow_{k}" for k in range(7, 0, -1))         # wow_7 ... wow_1
REPORT_COLUMNS = REPORT_KEYS + DAY_COLUMNS + WOW_COLUMNS + ("dod", "wow_week")

MEASURES = {"total": "sc_quantity", "reg": "sc_quantity_not_anypromo"}


def _window_sales(daily_sales: DataFrame, p: Params) -> DataFrame:
    return daily_sales.where(between("calc_date", p.history_from, p.history_to)
                             & store_kept("zavod", prefixes=p.sales_store_prefixes))


def _with_categories(per_plu: DataFrame, plu_cat: DataFrame, user_login: DataFrame) -> DataFrame:
    """Category (left) and manager -> user (left; several users per manager fan out)."""
    return (per_plu.join(plu_cat, on="plu", how="left")
                   .join(user_login, on=F.col("km") == F.col("category_manager"), how="left"))


def sales_by_category_day(daily_sales: DataFrame, plu_cat: DataFrame, user_login: DataFrame,
                          p: Params, measure: str = "sc_quantity") -> DataFrame:
    """Summed sales by day x user x category manager x category."""
    per_plu = (_window_sales(daily_sales, p)
               .groupBy("calc_date", "plu").agg(F.sum(measure).alias("sc_quantity")))
    return (_with_categories(per_plu, plu_cat, user_login)
            .groupBy("calc_date", "user", "km", "ui_5", "ui_5_name")
            .agg(F.sum("sc_quantity").alias("sc_quantity"))
            .select("calc_date", iso_weekday("calc_date").alias("day_num"),
                    "user", "km", "ui_5", "ui_5_name", "sc_quantity"))


def per_plu_sums(daily_sales: DataFrame, p: Params, measures) -> DataFrame:
    """Sales summed per (day, plu) inside the window, one column per measure."""
    return (_window_sales(daily_sales, p).groupBy("calc_date", "plu")
            .agg(*[F.sum(m).alias(m) for m in measures]))


def _report_sums(daily_sales: DataFrame, plu_cat: DataFrame, user_login: DataFrame,
                 p: Params, measure: str, per_plu: DataFrame | None = None) -> DataFrame:
    """Unrounded day sums ``s14 .. s1`` and week sums ``w1`` (days 1-7), ``w2`` (days 8-14)."""
    if per_plu is None:
        per_plu = per_plu_sums(daily_sales, p, [measure])
    per_plu = per_plu.select("calc_date", "plu", F.col(measure).alias("q"))
    joined = _with_categories(per_plu, plu_cat, user_login)
    def upto(name: str, newest: int, oldest: int):
        span = f"calc_date between DATE'{p.day(oldest)}' and DATE'{p.day(newest)}'"
        return F.expr(f"sum(case when {span} then q else 0BD end)").alias(name)
    sums = [upto(f"s{k}", k, k) for k in range(14, 0, -1)] + [upto("w1", 1, 7), upto("w2", 8, 14)]
    return joined.groupBy(*REPORT_KEYS).agg(*sums)


def day_matrix(daily_sales, plu_cat, user_login, p: Params, measure="sc_quantity") -> DataFrame:
    """The 14 daily sums per report key, rounded to one digit."""
    s = _report_sums(daily_sales, plu_cat, user_login, p, measure)
    return s.select(*REPORT_KEYS, *[F.expr(f"round(s{k}, 1) as d{k}") for k in range(14, 0, -1)])


def _growth_columns():
    cols = [pct_change(f"s{k}", f"s{k + 7}").alias(f"wow_{k}") for k in range(7, 0, -1)]
    cols.append(pct_change("s1", "s2").alias("dod"))
    cols.append(pct_change("w1", "w2").alias("wow_week"))
    return cols


def growth_rates(daily_sales, plu_cat, user_login, p: Params, measure="sc_quantity") -> DataFrame:
    """M1-M9: growth rates from the unrounded sums."""
    s = _report_sums(daily_sales, plu_cat, user_login, p, measure)
    return s.select(*REPORT_KEYS, *_growth_columns())


def report_rows(daily_sales, plu_cat, user_login, p: Params, measure="sc_quantity",
                per_plu: DataFrame | None = None) -> DataFrame:
    """Matrix and growth rates per report key, one pass."""
    s = _report_sums(daily_sales, plu_cat, user_login, p, measure, per_plu)
    return s.select(*REPORT_KEYS,
                    *[F.expr(f"round(s{k}, 1) as d{k}") for k in range(14, 0, -1)],
                    *_growth_columns())


def total_row(rows: DataFrame, p: Params) -> DataFrame:
    """Sums of the already rounded cells; growth from those sums; no weekly growth.

    A global aggregate, so it yields one row even when ``rows`` is empty.
    """
    sums = rows.agg(*[F.sum(c).alias(c) for c in DAY_COLUMNS])
    label = F.lit(p.total_label)
    return sums.select(
        label.alias("user"), label.alias("ui_5"), label.alias("ui_5_name"),
        *DAY_COLUMNS,
        *[pct_change(f"d{k}", f"d{k + 7}").alias(f"wow_{k}") for k in range(7, 0, -1)],
        pct_change("d1", "d2").alias("dod"),
        F.lit(None).cast("double").alias("wow_week"),
    )


def dbd_report(daily_sales, plu_cat, user_login, p: Params, measure="sc_quantity",
               ordered: bool = True, per_plu: DataFrame | None = None) -> DataFrame:
    """Full report: total row + rows, by yesterday's sales descending (NULL first)."""
    rows = report_rows(daily_sales, plu_cat, user_login, p, measure, per_plu)
    out = total_row(rows, p).unionByName(rows)
    return out.orderBy(F.col("d1").desc_nulls_first()) if ordered else out


def dbd_sections(daily_sales, plu_cat, user_login, p: Params,
                 section_col: str = "section") -> DataFrame:
    """Both reports (``total`` and ``reg``) in one frame with a section column.

    The sales window is read and pre-aggregated once with both measures; the two reports
    branch from that one aggregate (its exchange is reused), so a reader of both scans the
    sales table once instead of twice. The batch writes each report as its own section, in order.
    """
    shared = per_plu_sums(daily_sales, p, list(MEASURES.values()))
    parts = [dbd_report(daily_sales, plu_cat, user_login, p, measure, ordered=False,
                        per_plu=shared).withColumn(section_col, F.lit(kind))
             for kind, measure in MEASURES.items()]
    return parts[0].unionByName(parts[1])
