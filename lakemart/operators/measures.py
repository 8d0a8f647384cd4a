"""Additive report measures: partial parts, merge, and final rounded values.

Every report measure is kept as exact, additive parts (row counts, whole
seconds, decimal amounts) until the last step. That makes two things possible:

* eager aggregation for a dimension that grows with the data (riders): the
  fact is first reduced by its foreign key (map-side combined, so a hot key
  shrinks before any shuffle), then joined, then re-grouped by the
  dimension's attributes. Exact because dimension keys are unique and the
  parts are sums. A dimension bounded by nature (calendar days, stations) is
  joined row by row instead (``join_then_aggregate``): Spark broadcasts it
  after checking its size, so the only shuffle is the final aggregation;
* rounding that does not depend on partitioning (see ``functions.exact``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import minutes_rounded, minutes_to_seconds, money_mean, money_rounded


@dataclass(frozen=True)
class Measure:
    parts: tuple[tuple[str, Column], ...]
    finals: dict[str, Column] = field(default_factory=dict)

    def partial(self) -> list[Column]:
        """Aggregates over fact rows."""
        return [expr.alias(name) for name, expr in self.parts]

    def merge(self) -> list[Column]:
        """Aggregates over rows that already hold parts (all parts are sums)."""
        return [F.sum(name).alias(name) for name, _ in self.parts]

    def final(self, names: Sequence[str]) -> list[Column]:
        return [self.finals[n].alias(n) for n in names]


def ride_measure(minutes: str = "trip_duration_minutes") -> Measure:
    return Measure(
        parts=(
            ("_rides", F.count(F.lit(1))),
            ("_timed", F.count(F.col(minutes))),
            ("_seconds", F.sum(minutes_to_seconds(minutes))),
        ),
        finals={
            "ride_count": F.col("_rides"),
            "avg_trip_minutes": minutes_rounded("_seconds", "_timed"),
            "total_trip_minutes": minutes_rounded("_seconds", 1),
            # names used by the monthly report
            "rides_per_month": F.col("_rides"),
            "minutes_per_month": minutes_rounded("_seconds", 1),
        },
    )


def payment_measure(amount: str = "payment_amount") -> Measure:
    return Measure(
        parts=(
            ("_payments", F.count(F.lit(1))),
            ("_priced", F.count(F.col(amount))),
            ("_amount", F.sum(F.col(amount))),
        ),
        finals={
            "payment_count": F.col("_payments"),
            "total_amount": money_rounded("_amount"),
            "avg_payment_amount": money_mean("_amount", "_priced"),
            "spend_per_month": money_rounded("_amount"),
        },
    )


def aggregate(df: DataFrame, keys: Sequence[Column | str], measure: Measure, merge: bool = False) -> DataFrame:
    aggs = measure.merge() if merge else measure.partial()
    return df.groupBy(*keys).agg(*aggs)


def join_then_aggregate(
    fact: DataFrame,
    fact_key: str,
    dim: DataFrame,
    dim_key: str,
    group: Sequence[Column | str],
    measure: Measure,
) -> DataFrame:
    """fact LEFT JOIN dim ON fact_key = dim_key, grouped by ``group``.

    No join strategy is forced: Spark broadcasts ``dim`` when its estimated
    size is under ``spark.sql.autoBroadcastJoinThreshold`` (then the join is a
    map-side lookup and the partial aggregate runs before the one shuffle),
    AQE re-checks with runtime sizes, and beyond that it is a sort-merge join
    whose skewed partitions AQE splits."""
    joined = fact.join(dim, fact[fact_key] == dim[dim_key], "left")
    return aggregate(joined, group, measure)


def via_dimension(
    fact: DataFrame,
    fact_key: str,
    dim: DataFrame,
    dim_key: str,
    group: Sequence[Column],
    measure: Measure,
    extra_fact_keys: Sequence[str] = (),
) -> DataFrame:
    """fact LEFT JOIN dim ON fact_key = dim_key, grouped by ``group``, aggregated early.

    Equal to joining every fact row and aggregating (left join: fact rows with
    an unknown or NULL key land in the group whose dimension attributes are
    NULL), but the join sees one row per distinct fact key instead of one per
    fact row. ``extra_fact_keys`` are fact columns also used in ``group``.
    """
    pre = aggregate(fact, [fact_key, *extra_fact_keys], measure)
    joined = pre.join(dim, pre[fact_key] == dim[dim_key], "left")
    return aggregate(joined, group, measure, merge=True)
