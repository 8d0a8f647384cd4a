"""Exact integer rounding, on longs or on decimal(38,0) columns.

Averages of doubles depend on the order in which partial sums are added, so
the same data can round differently on a different partitioning. Reports keep
their measures as exact integers (seconds, cents, counts) and round once, here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = "decimal(38,0)"


def floor_div(x: Column, y: Column) -> Column:
    """floor(x / y) for y > 0, exact (NULL when y is NULL)."""
    x = x.cast(_INT)
    y = y.cast(_INT)
    return ((x - F.pmod(x, y)) / y).cast(_INT)


def half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) to an integer, halves away from zero (Java HALF_UP).

    ``num`` and ``den`` are integral; ``den`` must be positive, a zero or NULL
    ``den`` gives NULL."""
    num = num.cast(_INT)
    den = F.when(den.cast(_INT) > 0, den.cast(_INT))
    q = floor_div(F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -q).otherwise(q)


def floor_div_long(x: Column, y: Column) -> Column:
    """floor(x / y) for longs x >= 0 and 0 < y < 2^52, exact.

    The double quotient q0 is off by at most a few units; the exact long
    remainder r = x - q0 * y is then small, and q0 + floor(r / y) is exact.
    Stays in generated code (no BigDecimal); under ANSI an overflow raises
    instead of returning a wrong value."""
    x = x.cast("long")
    y = y.cast("long")
    q0 = F.floor(x / y).cast("long")
    return q0 + F.floor((x - q0 * y) / y).cast("long")


def half_up_div_long(num: Column, den: Column) -> Column:
    """``half_up_div`` on longs (|2 * num + den| must fit a long)."""
    num = num.cast("long")
    den = F.when(den.cast("long") > 0, den.cast("long"))
    q = floor_div_long(F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -q).otherwise(q)
