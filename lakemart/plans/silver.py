"""Silver layer: typed, quality-filtered rows of each raw feed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakemart.functions import duration_minutes
from lakemart.operators import standardize
from lakemart.schemas import PAYMENTS, RIDERS, STATIONS, TRIPS


def clean_stations(raw: DataFrame) -> DataFrame:
    """Typed stations; rows without a station_id dropped."""
    return standardize(raw, STATIONS)


def clean_riders(raw: DataFrame) -> DataFrame:
    """Typed riders; rows without a rider_id dropped."""
    return standardize(raw, RIDERS)


def clean_payments(raw: DataFrame) -> DataFrame:
    """Rows need a payment_id and a rider_id; a bad date or amount only nulls that column."""
    return standardize(raw, PAYMENTS)


def clean_trips(raw: DataFrame) -> DataFrame:
    """T4: typed trips plus ``trip_duration_minutes``; negative and zero durations are kept."""
    return standardize(
        raw,
        TRIPS,
        extra={"trip_duration_minutes": duration_minutes("started_at", "ended_at")},
    )


CLEANERS = {
    "stations": clean_stations,
    "riders": clean_riders,
    "payments": clean_payments,
    "trips": clean_trips,
}
