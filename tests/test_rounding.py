"""Section 2.8: growth percentages computed on doubles equal exact decimal arithmetic."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from demandlens.functions.measures import pct_change


def exact(x: int, y: int) -> float | None:
    if y == 0:
        return None
    v = (Decimal(x) / Decimal(y) - 1) * 100
    return float(v.quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))


def test_pct_change_equals_exact_decimal_on_integer_grid(spark):
    n = 400
    grid = (spark.range(0, (n + 1) * (n + 1))
            .select((F.col("id") % (n + 1)).cast("double").alias("x"),
                    (F.col("id") / (n + 1)).cast("long").cast("double").alias("y")))
    got = grid.select("x", "y", pct_change("x", "y").alias("g")).collect()
    bad = [(r.x, r.y, r.g) for r in got if r.g != exact(int(r.x), int(r.y))]
    assert len(got) == (n + 1) ** 2
    assert bad == []


def test_pct_change_known_pairs(spark):
    rows = spark.createDataFrame([(29.0, 80.0), (1.0, 8.0), (3.0, 0.0), (None, 5.0)], "x double, y double")
    got = [r.g for r in rows.select(pct_change("x", "y").alias("g")).collect()]
    assert got == [-63.8, -87.5, None, None]


def test_oracle_comparer_detects_differences(spark):
    """The comparer behind every oracle test is not vacuous."""
    import pandas as pd

    import oracle.compare as oc
    df = spark.createDataFrame([(1, 0.1 + 0.2, "a"), (2, None, "b")], "k int, v double, s string")
    same = pd.DataFrame({"s": ["b", "a"], "k": [2, 1], "v": [None, 0.1 + 0.2]})
    assert oc.same_rows(df, same)[0]                      # order of rows and columns ignored
    changed = same.assign(s=["b", "c"])
    assert not oc.same_rows(df, changed)[0]
    assert not oc.same_rows(df, same.iloc[:1])[0]         # a missing row
    off_by_ulp = same.assign(v=[None, 0.3])               # 0.1 + 0.2 != 0.3 in binary
    old = oc.EXACT
    try:
        oc.EXACT = True
        assert not oc.same_rows(df, off_by_ulp)[0]
        oc.EXACT = False
        assert oc.same_rows(df, off_by_ulp)[0]
    finally:
        oc.EXACT = old
