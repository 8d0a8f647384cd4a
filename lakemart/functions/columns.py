"""Scalar column expressions used by the layers. All are built-in Spark
expressions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.functions.exact import half_up_div, half_up_div_long


def col_or_name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed(text: Column | str, spark_type: str) -> Column:
    """Cast raw text to ``spark_type``; unparsable text becomes NULL (never an error).

    An id (``bigint``) may be written as a decimal, as in ``7.0``; its fraction is cut off."""
    text = col_or_name(text)
    if spark_type == "bigint":
        return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,9)").try_cast("bigint"))
    return text.try_cast(spark_type)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole epoch seconds of a timestamp, floored (bigint)."""
    return col_or_name(ts).cast("long")


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """(floor epoch seconds of end - floor epoch seconds of start) / 60, as double.

    Negative and zero durations are kept as they are."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def minutes_to_seconds(minutes: Column | str) -> Column:
    """Exact whole seconds behind a ``duration_minutes`` value.

    ``duration_minutes`` is an integer number of seconds divided by 60.0, so
    seconds = round(minutes * 60) recovers it exactly for any duration below
    ~10^14 s. Summing these longs keeps ride-time totals exact and independent
    of partitioning, unlike summing the doubles."""
    return F.round(col_or_name(minutes) * F.lit(60.0)).cast("long")


def date_key(d: Column | str) -> Column:
    """yyyyMMdd as bigint (equals date_format(d, 'yyyyMMdd') for years 1-9999;
    a later year is simply longer)."""
    d = col_or_name(d)
    return F.year(d).cast("long") * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def whole_years_between(later: Column | str, earlier: Column | str) -> Column:
    """floor(months_between(later, earlier) / 12): age in whole years (bigint)."""
    return F.floor(F.months_between(col_or_name(later), col_or_name(earlier)) / F.lit(12))


# --- fixed values: the two member classes.
MEMBER = "member"
CASUAL = "casual"


def member_type(is_member: Column | str) -> Column:
    """'member' only when is_member is true; false, NULL and unknown riders are 'casual'."""
    return F.when(col_or_name(is_member) == F.lit(True), F.lit(MEMBER)).otherwise(F.lit(CASUAL))


def minutes_rounded(seconds: Column | str, count: Column | str | int = 1) -> Column:
    """round(seconds / 60 / count, 2) HALF_UP, computed exactly, as double.

    With ``count`` = number of rides this is the average ride minutes, with
    ``count`` = 1 the total ride minutes. NULL when ``count`` is 0 or NULL."""
    count = F.lit(count) if isinstance(count, int) else col_or_name(count)
    cents = half_up_div_long(col_or_name(seconds).cast("long") * 100, count.cast("long") * 60)
    return cents.cast("double") / F.lit(100.0)


def money_rounded(amount_sum: Column | str) -> Column:
    """A sum of decimal(18,2) amounts as decimal(38,2) (the round to 2 places is exact)."""
    return col_or_name(amount_sum).cast("decimal(38,2)")


def money_mean(amount_sum: Column | str, count: Column | str) -> Column:
    """round(avg(amount), 2) with Spark's decimal semantics, computed exactly.

    ``avg`` of a decimal(18,2) yields decimal(22,6) (HALF_UP at 6 places) and the
    report rounds that to 2 places HALF_UP; both steps are reproduced on the
    exact sum of cents, so the result does not depend on partitioning."""
    cents = col_or_name(amount_sum).cast("decimal(38,2)") * 100
    micro = half_up_div(cents.cast("decimal(38,0)") * 10000, col_or_name(count).cast("decimal(38,0)"))
    out_cents = half_up_div(micro, F.lit(10000).cast("decimal(38,0)"))
    return (out_cents / F.lit(100)).cast("decimal(38,2)")


def money_ratio(amount_sum: Column | str, count: Column | str) -> Column:
    """round(amount_sum / count, 2) HALF_UP, exact, as decimal(38,2)."""
    cents = (col_or_name(amount_sum).cast("decimal(38,2)") * 100).cast("decimal(38,0)")
    return (half_up_div(cents, col_or_name(count)) / F.lit(100)).cast("decimal(38,2)")


def ratio_rounded(num: Column | str, den: Column | str) -> Column:
    """round(num / den, 2) HALF_UP for integral num and den, exact, as double."""
    q = half_up_div_long(col_or_name(num).cast("long") * 100, col_or_name(den))
    return q.cast("double") / F.lit(100.0)
