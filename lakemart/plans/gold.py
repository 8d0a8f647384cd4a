"""Gold layer: the star schema (three dimensions, two facts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import date_key, whole_years_between
from lakemart.functions.daymaps import day_words, days_of
from lakemart.operators import one_row_per_key
from lakemart.schemas import (
    DIM_DATE_COLUMNS,
    DIM_RIDER_COLUMNS,
    DIM_STATION_COLUMNS,
    FACT_PAYMENT_COLUMNS,
    FACT_TRIP_COLUMNS,
)


def dim_rider(riders: DataFrame) -> DataFrame:
    """T5: one row per rider_id (address dropped); duplicates resolved deterministically."""
    return one_row_per_key(riders, "rider_id", DIM_RIDER_COLUMNS)


def dim_station(stations: DataFrame) -> DataFrame:
    """One row per station_id."""
    return one_row_per_key(stations, "station_id", DIM_STATION_COLUMNS)


def observed_dates(trips: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct non-null dates seen as trip start, trip end or payment date.

    The two trip dates come from one scan (``explode`` of a two-element array)
    instead of a union of two scans of the trips table. A task hands on a bitmap
    word for each 64 days it met (``functions.daymaps``), not its distinct dates.
    """
    trip_days = trips.select(
        F.explode(F.array(F.to_date("started_at"), F.to_date("ended_at"))).alias("date")
    )
    pay_days = payments.select(F.col("payment_date").alias("date"))
    return days_of(day_words(trip_days.unionByName(pay_days)), "date")


def dim_date(trips: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per observed date (not a full calendar); day_of_week 1 = Sunday."""
    d = F.col("date")
    return observed_dates(trips, payments).select(
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
    ).select(*DIM_DATE_COLUMNS)


def fact_trip(trips: DataFrame, riders_dim: DataFrame) -> DataFrame:
    """T8 (J1): one row per silver trip, with date keys and the rider's age at the trip.

    Left join: trips of unknown riders are kept with a NULL age. Only
    (rider_id, birthday) of the dimension is read. Spark picks the join: a
    broadcast when the dimension is known to be small, otherwise a sort-merge
    join whose skewed partitions (one very active rider) AQE splits.
    """
    r = riders_dim.select("rider_id", F.col("birthday").alias("_birthday"))
    t = trips.join(r, "rider_id", "left")
    return t.select(
        "trip_id",
        "rider_id",
        "start_station_id",
        "end_station_id",
        date_key(F.to_date("started_at")).alias("start_date_key"),
        date_key(F.to_date("ended_at")).alias("end_date_key"),
        "rideable_type",
        "trip_duration_minutes",
        whole_years_between("started_at", "_birthday").alias("rider_age_at_trip"),
    ).select(*FACT_TRIP_COLUMNS)


def fact_payment(payments: DataFrame) -> DataFrame:
    """One row per silver payment; a missing date gives a NULL date key."""
    return payments.select(
        "payment_id",
        "rider_id",
        date_key("payment_date").alias("payment_date_key"),
        F.col("amount").alias("payment_amount"),
    ).select(*FACT_PAYMENT_COLUMNS)
