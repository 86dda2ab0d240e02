"""Exact arithmetic for money, scores and coordinates.

Money arrives as ``double`` with two decimals.  Sums of doubles depend on the
order in which a cluster adds them, so aggregates run on integer hundredths and
are turned back into ``double`` at the end.  ``bigint`` keeps the aggregation
buffer fixed-width, so Spark stays on hash aggregation; an overflow (more than
9e16 currency units in one group) raises under ANSI instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The value, or NULL where it is NaN or infinite, which no money or coordinate can be."""
    return F.when(F.abs(as_col(c)) < float("inf"), as_col(c))


def cents(c: Column | str) -> Column:
    """Integer hundredths of a value that carries at most two decimals."""
    return F.rint(as_col(c) * 100).cast("bigint")


def half_up_div(num: Column, den: Column, scale: int = 1) -> Column:
    """``num * scale / den`` as bigint, ties away from zero; NULL when ``den`` is 0.

    Quotient and remainder are scaled apart, so nothing larger than the result
    or ``den * scale`` is ever formed.
    """
    den = F.nullif(den, F.lit(0))
    size = F.abs(num)
    rest = (size % den) * scale
    magnitude = F.call_function("div", size, den) * scale + F.call_function("div", rest, den)
    magnitude = magnitude + ((rest % den) * 2 >= den).cast("bigint")
    return F.when(num < 0, -magnitude).otherwise(magnitude)


def money_sum(c: Column | str) -> Column:
    """Aggregate: sum, exact to two decimals."""
    return F.sum(cents(c)) / F.lit(100.0)


def money_ratio(total_cents: Column, n: Column) -> Column:
    """``total / n`` rounded half-up to two decimals."""
    return half_up_div(total_cents, n) / F.lit(100.0)


def money_mean(c: Column | str) -> Column:
    """Aggregate: mean of the non-NULL values, rounded half-up to two decimals."""
    return money_ratio(F.sum(cents(c)), F.count(as_col(c)))


def int_mean(c: Column | str, divisor: int = 1) -> Column:
    """Aggregate: mean of ``c / divisor`` rounded half-up to two decimals, ``c`` integral."""
    c = as_col(c)
    return half_up_div(F.sum(c.cast("bigint")), F.count(c) * divisor, scale=100) / F.lit(100.0)


def coordinate(c: Column | str) -> Column:
    """Degrees as ``decimal(18,12)``: summed exactly, still a long inside Spark."""
    return as_col(c).cast("decimal(18,12)")


def coordinate_mean(total: Column, n: Column) -> Column:
    """``total / n`` rounded half-up to six decimals, from exact decimal sums.

    ``total`` is cast to ``decimal(28,12)`` and ``n`` to ``decimal(19,0)`` so
    that no intermediate needs more than 38 digits.
    """
    total = total.cast("decimal(28,12)")
    den = F.nullif(n, F.lit(0)).cast("decimal(19,0)")
    micro = F.call_function(
        "div", F.abs(total) * F.lit(2_000_000).cast("decimal(7,0)") + den, den * F.lit(2).cast("decimal(1,0)")
    )
    return F.when(total < 0, -micro).otherwise(micro) / F.lit(1e6)


def round2(c: Column) -> Column:
    """``round(c, 2)``, without decimal arithmetic for values that have two decimals already."""
    return F.when(F.rint(c * 100) / 100 == c, c).otherwise(F.round(c, 2))


def mismatch(a: Column, b: Column) -> Column:
    """True when two values differ; NULL against non-NULL is a difference."""
    return ~a.eqNullSafe(b)


def off_by_more_than(a: Column, b: Column, tolerance: float) -> Column:
    """True when ``|a - b| > tolerance`` or exactly one side is NULL."""
    return F.coalesce(F.abs(a - b) > tolerance, a.isNull() != b.isNull())
