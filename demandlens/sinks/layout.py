"""The forecast table in the layout that the peak jobs want.

Partitioned by snapshot day, a job reads one day of it; bucketed and sorted by (material, store),
the windows of a series and the max/min aggregate find their rows together and need no exchange.
A snapshot is dealt into its buckets before it is written, so each bucket of a day is one file.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from demandlens.functions.predicates import current
from demandlens.sources.roles import SCHEMAS

DAY = "snapshot_date"
SERIES = ("material", "store")
COLUMNS = (*[c for c in SCHEMAS["forecast"].fieldNames() if c != DAY], DAY)


def _dealt(forecast: DataFrame, buckets: int) -> DataFrame:
    return (forecast.select(*COLUMNS).repartition(buckets, *SERIES)
            .sortWithinPartitions(DAY, *SERIES, "forecast_date"))


def create_forecast(forecast: DataFrame, table: str, buckets: int) -> None:
    """Create the catalog table ``table`` with the snapshots of ``forecast``."""
    (_dealt(forecast, buckets).write.format("parquet").partitionBy(DAY)
     .bucketBy(buckets, *SERIES).sortBy(*SERIES, "forecast_date").saveAsTable(table))


def replace_snapshot(forecast: DataFrame, table: str, day: date, buckets: int) -> None:
    """Put the snapshot of ``day`` in ``forecast`` in place of that day of ``table``.

    The day is named as a static partition, so that no other day is touched whatever the
    session's overwrite mode. Loading a day again replaces it; a replay leaves no duplicates.
    """
    rows = _dealt(forecast.where(current(DAY, day)), buckets).drop(DAY)
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({DAY} = DATE'{day}') SELECT * FROM {{rows}}",
        rows=rows)
