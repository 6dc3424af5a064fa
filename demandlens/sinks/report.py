"""Report sink.

A report is a directory (one per workbook) and each job's result is one section in it, the
folder ``section=<name>``. Sibling sections (``reg`` and ``total`` of the sales report) are not
touched, and an empty result leaves an empty section with its schema, so a clean day never shows
yesterday's rows.

A section's rows lie in versions, folders ``v-<id>`` of it, written by normal distributed Spark
writes. The file ``_current`` names the version that counts. It is one small file, replaced by
one rename after the version is complete: a reader sees the old rows or the new ones and never
none or a mixture, whenever a writer stops. The version before stays for readers that have
opened it; older ones are removed. What writers that crashed left behind goes by ``vacuum``.

Rows keep their order over any number of files: a range-partitioned sort hands out rows in
order of partition and place, so that ``monotonically_increasing_id`` is a position for free;
it is stored with the rows and ``read_section`` sorts by it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.sinks.files import at, exists, listed, read_json, remove, write_json

# --- fixed values: display headers of the report columns ------------------------------------
PRODUCT_LABELS = {
    "manager": "Категорийный_менеджм", "name": "Название",
    "node_2": "Узел_2", "node_2_name": "Описание_2", "node_3": "Узел_3", "node_3_name": "Описание_3",
    "node_4": "Узел_4", "node_4_name": "Описание_4", "node_5": "Узел_5", "node_5_name": "Описание_5",
}
OLD_PEAK_LABELS = {
    "ppm_type": "Тип ППМ", "peak_eve_value": "Прогноз_за_день_до_пика",
    "last_year_sales": "Продажи_прошлого_года_в_день_пика", "peak_day": "День_пика",
    "peak_value": "Значение_пика", "avg_sales": "Ср_продажи_за_21_день",
    "peak_on_weekend": "Пик_в_выходной", "has_s4_adjustment": "есть_с4_корректировка",
    "has_car_adjustment": "есть_кар_корректировка", "final_forecast": "финальный_прогноз",
}
SALES_LABELS = {
    "d14": "14 days ago", "d13": "13 days ago", "d12": "12 days ago", "d11": "11 days ago",
    "d10": "10 days ago", "d9": "9 days ago", "d8": "8 days ago", "d7": "7 days ago",
    "d6": "6 days ago", "d5": "5 days ago", "d4": "4 days ago", "d3": "3 days ago",
    "d2": "2 days ago", "d1": "1 day ago",
    "wow_7": "7_Рост %", "wow_6": "6_Рост %", "wow_5": "5_Рост %", "wow_4": "4_Рост %",
    "wow_3": "3_Рост %", "wow_2": "2_Рост %", "wow_1": "1_Рост %",
    "dod": "Рост в прошлому дню %", "wow_week": "Недельный рост %",
}
# ----------------------------------------------------------------------------------------------

LABELS = {
    "system_antipeaks": PRODUCT_LABELS,
    "old_peaks": {**PRODUCT_LABELS, **OLD_PEAK_LABELS},
    "new_peaks": PRODUCT_LABELS,
    "antipeaks": PRODUCT_LABELS,
    "dbd_reg": SALES_LABELS,
    "dbd_total": SALES_LABELS,
}


def normalise_dates(df: DataFrame, column: str = "forecast_date") -> DataFrame:
    """The forecast date is reported as a date (no time part), when the column exists."""
    if column not in df.columns:
        return df
    if isinstance(df.schema[column].dataType, T.DateType):
        return df
    return df.withColumn(column, F.to_date(F.col(column)))


def display(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Rename columns to their display headers (columns without a label keep their name)."""
    return df.select(*[F.col(c).alias(labels.get(c, c)) for c in df.columns])


def create_report(spark: SparkSession, path: str) -> None:
    """Create an empty report; a report that exists is left as it is."""
    fs, where = at(spark, path)
    fs.mkdirs(where)


POSITION = "_position"           # stored order of the rows
POINTER = "_current"
KEPT = 1                         # versions kept beside the current one


def section_path(path: str, section: str) -> str:
    return f"{path}/section={section}"


def _pointer(spark: SparkSession, target: str) -> dict | None:
    """What ``_current`` says: the version, and the versions before it, newest first."""
    return read_json(spark, f"{target}/{POINTER}")


def write_version(df: DataFrame, target: str, fmt: str = "parquet") -> str:
    """Write ``df`` as a new version of the section folder ``target``; it does not count yet."""
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).save(f"{target}/{version}")
    return version


def publish(spark: SparkSession, target: str, version: str) -> None:
    """Make a complete version the one that counts, and drop versions beyond the kept ones."""
    held = _pointer(spark, target)
    before = [held["version"], *held["before"]] if held else []
    write_json(spark, f"{target}/{POINTER}", {"version": version, "before": before[:KEPT]})
    for old in before[KEPT:]:
        remove(spark, f"{target}/{old}")


def vacuum(spark: SparkSession, path: str, section: str, older_than_s: float = 86_400) -> list[str]:
    """Remove versions that nothing names and that are older than a writer takes."""
    target = section_path(path, section)
    held = _pointer(spark, target) or {"version": None, "before": []}
    named = {held["version"], *held["before"], POINTER}
    gone = []
    for status in listed(spark, target):
        name = status.getPath().getName()
        old = time.time() - status.getModificationTime() / 1000 > older_than_s
        if name not in named and name.startswith(("v-", "_")) and old:
            remove(spark, f"{target}/{name}")
            gone.append(name)
    return gone


def current_version(spark: SparkSession, path: str, section: str) -> str | None:
    """Path of the version that counts, or None."""
    target = section_path(path, section)
    held = _pointer(spark, target)
    return f"{target}/{held['version']}" if held else None


def drop_section(spark: SparkSession, path: str, section: str) -> None:
    """Remove a section: its pointer first, so that no reader starts on half a section."""
    target = section_path(path, section)
    remove(spark, f"{target}/{POINTER}")
    remove(spark, target)


def sections(spark: SparkSession, path: str) -> list[str]:
    """Names of the sections that have a version that counts."""
    names = [s.getPath().getName() for s in listed(spark, path)]
    return sorted(n.removeprefix("section=") for n in names if n.startswith("section=")
                  and exists(spark, f"{path}/{n}/{POINTER}"))


def write_section(df: DataFrame, path: str, section: str, *, must_exist: bool = True,
                  labels: dict[str, str] | None = None, fmt: str = "parquet") -> str:
    """Replace section ``section`` of the report at ``path`` and leave the others alone.

    The report must exist, as in the monitored batch, where a missing workbook stops the job;
    ``must_exist=False`` creates it. Returns the path of the version written.
    """
    spark = df.sparkSession
    if must_exist and not exists(spark, path):
        raise FileNotFoundError(f"report does not exist (creation not allowed): {path}")
    out = normalise_dates(df)
    if labels:
        out = display(out, labels)
    target = section_path(path, section)
    version = write_version(out.withColumn(POSITION, F.monotonically_increasing_id()), target, fmt)
    publish(spark, target, version)
    return f"{target}/{version}"


def read_section(spark: SparkSession, path: str, section: str, fmt: str = "parquet") -> DataFrame:
    """A section's rows, in the order in which they were written."""
    where = current_version(spark, path, section)
    if where is None:
        raise FileNotFoundError(f"no section {section} in {path}")
    return spark.read.format(fmt).load(where).orderBy(POSITION).drop(POSITION)
