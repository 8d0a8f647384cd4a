"""Reports on the star schema.

Each report is the source program's join-then-group on exact, additive
measure parts (``operators.measures``). Joins to the bounded dimensions
(dates, stations) stay row-by-row so Spark can broadcast them after its size
check and the only shuffle is the final aggregation. Joins to the rider
dimension, which grows with the user base, are planned group-then-join
(``via_dimension``): the fact is reduced per rider map-side first, so the
join sees one row per rider (and key) instead of one per trip, and a rider
with a third of all trips is combined before any shuffle. Both plans give
the plain plan's result (checked in the tests): dimension keys are unique
and the measures are exact sums.

Sorts follow the source program; where it leaves ties open the group keys
break them, so the order is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import (
    member_type,
    minutes_rounded,
    money_ratio,
    ratio_rounded,
    whole_years_between,
)
from lakemart.operators import aggregate, join_then_aggregate, payment_measure, ride_measure, via_dimension

RIDE_AVG = ("ride_count", "avg_trip_minutes")
RIDE_AVG_TOTAL = ("ride_count", "avg_trip_minutes", "total_trip_minutes")
PAYMENT_MEASURES = ("payment_count", "total_amount", "avg_payment_amount")


def _dates(dim_date: DataFrame, *cols: str) -> DataFrame:
    return dim_date.select("date_key", *cols)


def _station_names(dim_station: DataFrame, role: str) -> DataFrame:
    return dim_station.select(
        F.col("station_id").alias(f"_{role}_id"), F.col("name").alias(f"{role}_station")
    )


# ---------------------------------------------------------------- ride time


def rides_by_date_attrs(fact_trip: DataFrame, dim_date: DataFrame, attrs: tuple[str, ...],
                        measures: tuple[str, ...] = RIDE_AVG_TOTAL) -> DataFrame:
    """Ride time by start-date attributes of dim_date (year, month, day_of_week, ...)."""
    m = ride_measure()
    parts = join_then_aggregate(
        fact_trip, "start_date_key", _dates(dim_date, *attrs), "date_key", [F.col(a) for a in attrs], m
    )
    return parts.select(*attrs, *m.final(measures)).orderBy(*attrs)


def rides_by_year_month_dow(fact_trip: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Year, month, day_of_week -> ride_count, avg and total minutes."""
    return rides_by_date_attrs(fact_trip, dim_date, ("year", "month", "day_of_week"))


def rides_by_day(fact_trip: DataFrame, dim_date: DataFrame) -> DataFrame:
    """V1: ride time per calendar day."""
    return rides_by_date_attrs(fact_trip, dim_date, ("date",))


def rides_by_year(fact_trip: DataFrame, dim_date: DataFrame) -> DataFrame:
    """V1: ride time per year."""
    return rides_by_date_attrs(fact_trip, dim_date, ("year",))


def rides_by_hour(silver_trips: DataFrame, with_total: bool = False) -> DataFrame:
    """R2 (V4 with the total): hour of the start time -> ride_count, avg minutes.

    Reads silver trips, because the gold fact keeps dates only."""
    m = ride_measure()
    parts = aggregate(silver_trips, [F.hour("started_at").alias("hour_of_day")], m)
    measures = RIDE_AVG_TOTAL if with_total else RIDE_AVG
    return parts.select("hour_of_day", *m.final(measures)).orderBy("hour_of_day")


def rides_by_hour_total(silver_trips: DataFrame) -> DataFrame:
    return rides_by_hour(silver_trips, with_total=True)


def rides_by_station_pair(fact_trip: DataFrame, dim_station: DataFrame) -> DataFrame:
    """Start and end station *names* -> ride_count, avg minutes; busiest first.

    Stations sharing a name merge; unknown stations fall in the NULL name. Trips
    are first reduced by the pair of station ids (map-side combined), so the two
    joins see a row for each pair and no trip is shuffled, however large the
    station dimension is."""
    m = ride_measure()
    ss = _station_names(dim_station, "start")
    es = _station_names(dim_station, "end")
    pairs = aggregate(fact_trip, ["start_station_id", "end_station_id"], m)
    joined = (
        pairs.join(ss, pairs["start_station_id"] == ss["_start_id"], "left")
        .join(es, pairs["end_station_id"] == es["_end_id"], "left")
    )
    parts = aggregate(joined, ["start_station", "end_station"], m, merge=True)
    return parts.select("start_station", "end_station", *m.final(RIDE_AVG)).orderBy(
        F.desc("ride_count"), "start_station", "end_station"
    )


def rides_by_station_role(fact_trip: DataFrame, dim_station: DataFrame, role: str) -> DataFrame:
    """V2: ride time by start station name alone, or by end station name alone."""
    m = ride_measure()
    names = _station_names(dim_station, role)
    parts = join_then_aggregate(
        fact_trip, f"{role}_station_id", names, f"_{role}_id", [F.col(f"{role}_station")], m
    )
    key = f"{role}_station"
    return parts.select(key, *m.final(RIDE_AVG)).orderBy(F.desc("ride_count"), key)


def rides_by_start_station(fact_trip: DataFrame, dim_station: DataFrame) -> DataFrame:
    return rides_by_station_role(fact_trip, dim_station, "start")


def rides_by_end_station(fact_trip: DataFrame, dim_station: DataFrame) -> DataFrame:
    return rides_by_station_role(fact_trip, dim_station, "end")


def _rides_with_member(fact_trip: DataFrame, dim_rider: DataFrame, extra_keys: tuple[str, ...]):
    m = ride_measure()
    riders = dim_rider.select(F.col("rider_id").alias("_rid"), "is_member")
    parts = via_dimension(
        fact_trip, "rider_id", riders, "_rid",
        [member_type("is_member").alias("member_type"), *extra_keys], m, extra_fact_keys=extra_keys,
    )
    return m, parts


def rides_by_age_member(fact_trip: DataFrame, dim_rider: DataFrame) -> DataFrame:
    """member_type, rider_age_at_trip -> ride_count, avg minutes."""
    m, parts = _rides_with_member(fact_trip, dim_rider, ("rider_age_at_trip",))
    return parts.select("member_type", "rider_age_at_trip", *m.final(RIDE_AVG)).orderBy(
        "member_type", "rider_age_at_trip"
    )


def rides_by_member(fact_trip: DataFrame, dim_rider: DataFrame) -> DataFrame:
    """V3: ride time by member type alone."""
    m, parts = _rides_with_member(fact_trip, dim_rider, ())
    return parts.select("member_type", *m.final(RIDE_AVG)).orderBy("member_type")


def rides_by_age(fact_trip: DataFrame) -> DataFrame:
    """V3: ride time by age at trip alone (the age is already on the fact)."""
    m = ride_measure()
    parts = aggregate(fact_trip, ["rider_age_at_trip"], m)
    return parts.select("rider_age_at_trip", *m.final(RIDE_AVG)).orderBy("rider_age_at_trip")


# ---------------------------------------------------------------- money


def payments_by_month(fact_payment: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Year, quarter, month of payment -> count, total, average amount."""
    m = payment_measure()
    keys = ("year", "quarter", "month")
    parts = join_then_aggregate(
        fact_payment, "payment_date_key", _dates(dim_date, *keys), "date_key", [F.col(k) for k in keys], m
    )
    return parts.select(*keys, *m.final(PAYMENT_MEASURES)).orderBy(*keys)


def payments_rollup(fact_payment: DataFrame, dim_date: DataFrame) -> DataFrame:
    """V5: payments at month, quarter, year and overall level in one result.

    ``grouping_level`` is Spark's grouping_id over (year, quarter, month):
    0 month rows, 1 quarter subtotals, 3 year subtotals, 7 the grand total.
    Payments are added up by month first; the rollup expands those few rows,
    never the facts."""
    m = payment_measure()
    keys = ("year", "quarter", "month")
    months = join_then_aggregate(
        fact_payment, "payment_date_key", _dates(dim_date, *keys), "date_key", [F.col(k) for k in keys], m
    )
    parts = months.rollup(*keys).agg(*m.merge(), F.grouping_id().cast("int").alias("grouping_level"))
    return parts.select(*keys, "grouping_level", *m.final(PAYMENT_MEASURES)).orderBy(
        "grouping_level", *keys
    )


def _payments_per_rider(fact_payment: DataFrame, dim_rider: DataFrame) -> DataFrame:
    """Payment parts per rider joined to the rider's birthday and account start."""
    m = payment_measure()
    pre = aggregate(fact_payment, ["rider_id"], m)
    r = dim_rider.select(F.col("rider_id").alias("_rid"), "birthday", "account_start_date")
    return pre.join(r, pre["rider_id"] == r["_rid"], "left").withColumn(
        "age_at_account_start", whole_years_between("account_start_date", "birthday")
    )


def spend_by_rider(fact_payment: DataFrame, dim_rider: DataFrame) -> DataFrame:
    """rider_id, age_at_account_start -> total_amount; biggest spenders first.

    Payments are summed per rider before the join; with one dimension row per
    rider each rider is then exactly one group, so no second aggregation."""
    m = payment_measure()
    per_rider = _payments_per_rider(fact_payment, dim_rider)
    return per_rider.select("rider_id", "age_at_account_start", *m.final(("total_amount",))).orderBy(
        F.desc("total_amount"), "rider_id"
    )


def spend_by_start_age(fact_payment: DataFrame, dim_rider: DataFrame) -> DataFrame:
    """V6: spend by the rider characteristic age at account start."""
    m = payment_measure()
    per_rider = _payments_per_rider(fact_payment, dim_rider)
    parts = per_rider.groupBy("age_at_account_start").agg(
        *m.merge(), F.count(F.lit(1)).alias("rider_count")
    )
    return parts.select("age_at_account_start", "rider_count", *m.final(PAYMENT_MEASURES)).orderBy(
        "age_at_account_start"
    )


# ---------------------------------------------------------------- monthly


def _rides_monthly_parts(fact_trip: DataFrame, dim_date: DataFrame) -> DataFrame:
    m = ride_measure()
    return join_then_aggregate(
        fact_trip, "start_date_key", _dates(dim_date, "year", "month"), "date_key",
        ["rider_id", F.col("year"), F.col("month")], m,
    )


def _spend_monthly_parts(fact_payment: DataFrame, dim_date: DataFrame) -> DataFrame:
    m = payment_measure()
    return join_then_aggregate(
        fact_payment, "payment_date_key", _dates(dim_date, "year", "month"), "date_key",
        ["rider_id", F.col("year"), F.col("month")], m,
    )


def rides_monthly(fact_trip: DataFrame, dim_date: DataFrame) -> DataFrame:
    """rider_id, year, month -> rides_per_month, minutes_per_month."""
    m = ride_measure()
    return _rides_monthly_parts(fact_trip, dim_date).select(
        "rider_id", "year", "month", *m.final(("rides_per_month", "minutes_per_month"))
    )


def spend_monthly(fact_payment: DataFrame, dim_date: DataFrame) -> DataFrame:
    """rider_id, year, month -> spend_per_month."""
    m = payment_measure()
    return _spend_monthly_parts(fact_payment, dim_date).select(
        "rider_id", "year", "month", *m.final(("spend_per_month",))
    )


def _spend_and_rides_parts(fact_trip: DataFrame, fact_payment: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Payment rider-months LEFT JOIN ride rider-months on (rider_id, year, month).

    Both sides come out of an aggregation hash-partitioned on exactly these
    keys, so the join adds no shuffle of its own. NULL keys never match."""
    spend = _spend_monthly_parts(fact_payment, dim_date)
    rides = _rides_monthly_parts(fact_trip, dim_date).select("rider_id", "year", "month", "_rides", "_seconds")
    return spend.join(rides, ["rider_id", "year", "month"], "left")


def spend_and_rides_monthly(fact_trip: DataFrame, fact_payment: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly spend per rider with that month's rides and minutes (0 if none).

    Driven by payments: rider-months with rides and no payment are absent."""
    pm = payment_measure()
    joined = _spend_and_rides_parts(fact_trip, fact_payment, dim_date)
    return joined.select(
        "rider_id",
        "year",
        "month",
        *pm.final(("spend_per_month",)),
        F.coalesce(F.col("_rides"), F.lit(0).cast("long")).alias("rides_per_month"),
        F.coalesce(minutes_rounded("_seconds", 1), F.lit(0.0)).alias("minutes_per_month"),
    ).orderBy("year", "month", "rider_id")


def spend_vs_avg_rides(fact_trip: DataFrame, fact_payment: DataFrame, dim_date: DataFrame) -> DataFrame:
    """V7: per rider, average monthly spend next to average rides and minutes per month.

    Over the rider's payment months (the months of R9); a month without rides
    counts as 0 rides and 0 minutes. All averages are exact HALF_UP to 2 places."""
    joined = _spend_and_rides_parts(fact_trip, fact_payment, dim_date)
    per_rider = joined.groupBy("rider_id").agg(
        F.count(F.lit(1)).alias("months_paid"),
        F.sum("_amount").alias("_amount"),
        F.sum(F.coalesce(F.col("_rides"), F.lit(0).cast("long"))).alias("_rides"),
        F.sum(F.coalesce(F.col("_seconds"), F.lit(0).cast("long"))).alias("_seconds"),
    )
    return per_rider.select(
        "rider_id",
        "months_paid",
        F.col("_amount").cast("decimal(38,2)").alias("total_spend"),
        money_ratio("_amount", "months_paid").alias("avg_monthly_spend"),
        ratio_rounded("_rides", "months_paid").alias("avg_rides_per_month"),
        minutes_rounded("_seconds", "months_paid").alias("avg_minutes_per_month"),
    ).orderBy("rider_id")


# Every report by name, over layers (written or lazy) that expose the gold
# tables as attributes and silver trips as ``silver["trips"]``.
REPORTS = {
    "rides_by_year_month_dow": lambda L: rides_by_year_month_dow(L.fact_trip, L.dim_date),
    "rides_by_hour": lambda L: rides_by_hour(L.silver["trips"]),
    "rides_by_station_pair": lambda L: rides_by_station_pair(L.fact_trip, L.dim_station),
    "rides_by_age_member": lambda L: rides_by_age_member(L.fact_trip, L.dim_rider),
    "payments_by_month": lambda L: payments_by_month(L.fact_payment, L.dim_date),
    "spend_by_rider": lambda L: spend_by_rider(L.fact_payment, L.dim_rider),
    "rides_monthly": lambda L: rides_monthly(L.fact_trip, L.dim_date),
    "spend_monthly": lambda L: spend_monthly(L.fact_payment, L.dim_date),
    "spend_and_rides_monthly": lambda L: spend_and_rides_monthly(L.fact_trip, L.fact_payment, L.dim_date),
    "rides_by_day": lambda L: rides_by_day(L.fact_trip, L.dim_date),
    "rides_by_year": lambda L: rides_by_year(L.fact_trip, L.dim_date),
    "rides_by_start_station": lambda L: rides_by_start_station(L.fact_trip, L.dim_station),
    "rides_by_end_station": lambda L: rides_by_end_station(L.fact_trip, L.dim_station),
    "rides_by_age": lambda L: rides_by_age(L.fact_trip),
    "rides_by_member": lambda L: rides_by_member(L.fact_trip, L.dim_rider),
    "rides_by_hour_total": lambda L: rides_by_hour_total(L.silver["trips"]),
    "payments_rollup": lambda L: payments_rollup(L.fact_payment, L.dim_date),
    "spend_by_start_age": lambda L: spend_by_start_age(L.fact_payment, L.dim_rider),
    "spend_vs_avg_rides": lambda L: spend_vs_avg_rides(L.fact_trip, L.fact_payment, L.dim_date),
}
