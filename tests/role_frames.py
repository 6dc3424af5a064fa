"""Role frames from partial rows, for tests."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

from demandlens.sources.roles import SCHEMAS


def role_frame(spark, role: str, rows: list[dict]):
    """Build a role frame from partial rows; absent columns are NULL."""
    schema = SCHEMAS[role]
    data = [tuple(typed(r.get(f.name), f.dataType) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def typed(value, kind):
    """Numbers given for keys become text, numbers given for measures exact decimals."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return str(value)
    return Decimal(str(value)) if isinstance(kind, T.DecimalType) else value
