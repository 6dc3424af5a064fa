"""Scalar measures (F3-F17, M1-M14) as Column expressions.

Quantities are exact decimals. Thresholds are turned into exact decimals too, so a comparison
at the limit does not depend on binary fractions. Every divisor is guarded: with ANSI mode
on, a division by zero would fail the whole job.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlens.functions.predicates import col


def exact(value: float | int | Decimal) -> Column:
    """A threshold as the decimal that its text shows."""
    return F.lit(Decimal(str(value)))


def pct_change(x: str | Column, base: str | Column) -> Column:
    """Growth of ``x`` over ``base`` in percent, to one digit; NULL when ``base`` is 0 or NULL.

    Rounded half away from zero from the exact quotient: in thousandths both are whole
    numbers, and ``round(1000 * (x - base) / base)`` is a whole division of
    ``2000 * |x - base| + |base|`` by ``2 * |base|`` (29 over 80 gives -63.8).

    Names give one parsed expression: a report has twenty of these, and built call by call they
    took longer to plan than its sums to run.
    """
    if isinstance(x, str) and isinstance(base, str):
        return F.expr(_pct_change_text(x, base))
    x, base = (F.round(col(c) * 1000, 0).cast("decimal(30,0)") for c in (x, base))
    diff, size = x - base, F.nullif(F.abs(base), F.lit(0).cast("decimal(30,0)"))
    up = (F.abs(diff) * 2000 + size).cast("decimal(38,0)")
    down = (size * 2).cast("decimal(38,0)")
    tenths = F.call_function("div", up, down)
    # adding zero turns a negative zero into zero
    return F.signum(diff) * F.signum(base) * tenths / F.lit(10.0) + F.lit(0.0)


def _pct_change_text(x: str, base: str) -> str:
    x, base = (f"cast(round(`{c}` * 1000, 0) as decimal(30,0))" for c in (x, base))
    size = f"nullif(abs({base}), cast(0 as decimal(30,0)))"
    tenths = (f"(cast(abs({x} - {base}) * 2000 + {size} as decimal(38,0)) "
              f"div cast({size} * 2 as decimal(38,0)))")
    return f"signum({x} - {base}) * signum({base}) * {tenths} / 10.0D + 0.0D"


def adjustment_delta(total: str | Column, adjustment: str | Column) -> Column:
    """Percent change of ``total`` after ``adjustment``; 0 when there is no adjustment.

    ``((total + adj) / total - 1) * 100`` equals ``100 * adj / total``; both sides are exact,
    and their quotient is one correctly rounded double.
    """
    total, adjustment = col(total), col(adjustment)
    return (F.when(adjustment != 0, ratio(adjustment * 100, total)).otherwise(F.lit(0.0)))


def ratio(num: str | Column, den: str | Column) -> Column:
    """Plain ratio as a double; NULL instead of a failure on a zero denominator."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def nonzero_flag(c: str | Column) -> Column:
    """1 when the value is present and not 0, else 0."""
    return F.when(col(c) != 0, F.lit(1)).otherwise(F.lit(0))


def weekend_flag(d: str | Column) -> Column:
    """1 on Saturday or Sunday (``dayofweek`` is 1 = Sunday ... 7 = Saturday)."""
    return F.when(F.dayofweek(col(d)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def iso_weekday(d: str | Column) -> Column:
    """ISO day of week, 1 = Monday ... 7 = Sunday."""
    return F.weekday(col(d)) + F.lit(1)


def year_before(d: str | Column) -> Column:
    """F8: same day a year earlier; 29 February maps to 28 February."""
    return F.add_months(col(d), -12)
