"""Exact money and ratio arithmetic.

Rounding is done on integers (cents), half-up, so Spark and any other SQL
engine agree bit for bit: doubles round differently between engines and
decimal division keeps engine-specific scales.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BIG = "decimal(38,0)"


def idiv(a: Column, b: Column) -> Column:
    """Floor division of integers (SQL ``div`` for non-negative operands),
    exact: the numerator is made divisible first, then divided as decimals.
    NULL when ``b`` is 0 or NULL."""
    a, b = a.cast(_BIG), b.cast(_BIG)
    return F.when(b.isNull() | (b == 0), F.lit(None)).otherwise(
        ((a - F.pmod(a, b)) / b).cast("long"))


def cents(x: Column) -> Column:
    """Decimal amount with 2 places -> exact long number of cents."""
    return (x * 100).cast("long")


def from_cents(c: Column, precision: int = 12) -> Column:
    return (c.cast(_BIG) / 100).cast(f"decimal({precision},2)")


def half_up_ratio(num: Column, den: Column, places: int = 2, scale: int = 1) -> Column:
    """``round(scale * num / den, places)`` as a double, halves away from zero
    for either sign, for integer operands. NULL when ``den`` is 0 or NULL."""
    factor = scale * 10 ** places
    n, d = F.abs(num.cast(_BIG)), F.abs(den.cast(_BIG))
    q = idiv(n * F.lit(2 * factor) + d, d * 2)
    sign = F.when((num < 0) != (den < 0), F.lit(-1)).otherwise(F.lit(1))
    return (sign * q / F.lit(float(10 ** places))).cast("double")
