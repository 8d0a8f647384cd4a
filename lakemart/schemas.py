"""Column specs of the four raw feeds and of the star schema.

The raw feeds are header-less CSV files addressed by position. Every raw column
is read as text (no inference pass, no lost leading zeros); the silver step
casts by position with ``try_cast`` so that malformed text becomes NULL instead
of failing the job under ANSI mode.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class FeedSpec:
    """A raw feed: silver column names and types by position, plus required keys."""

    name: str
    columns: tuple[tuple[str, str], ...]
    required: tuple[str, ...]

    @property
    def width(self) -> int:
        return len(self.columns)

    @property
    def raw_names(self) -> list[str]:
        return [f"_c{i}" for i in range(self.width)]

    def raw_schema(self) -> T.StructType:
        """All-string positional schema used to read the raw CSV."""
        return T.StructType([T.StructField(n, T.StringType(), True) for n in self.raw_names])


# --- fixed values: silver layout of each feed (name, type) by CSV position and the
# --- keys whose NULL drops the row. These must equal the source program's layout.
STATIONS = FeedSpec(
    "stations",
    (
        ("station_id", "string"),
        ("name", "string"),
        ("latitude", "double"),
        ("longitude", "double"),
    ),
    ("station_id",),
)

RIDERS = FeedSpec(
    "riders",
    (
        ("rider_id", "bigint"),
        ("first", "string"),
        ("last", "string"),
        ("address", "string"),
        ("birthday", "date"),
        ("account_start_date", "date"),
        ("account_end_date", "date"),
        ("is_member", "boolean"),
    ),
    ("rider_id",),
)

PAYMENTS = FeedSpec(
    "payments",
    (
        ("payment_id", "bigint"),
        ("payment_date", "date"),
        ("amount", "decimal(18,2)"),
        ("rider_id", "bigint"),
    ),
    ("payment_id", "rider_id"),
)

TRIPS = FeedSpec(
    "trips",
    (
        ("trip_id", "string"),
        ("rideable_type", "string"),
        ("started_at", "timestamp"),
        ("ended_at", "timestamp"),
        ("start_station_id", "string"),
        ("end_station_id", "string"),
        ("rider_id", "bigint"),
    ),
    ("trip_id", "started_at", "ended_at", "rider_id"),
)

FEEDS: dict[str, FeedSpec] = {f.name: f for f in (STATIONS, RIDERS, PAYMENTS, TRIPS)}

# --- fixed values: catalog layers and gold table names.
LAYERS = ("bronze", "silver", "gold")
SILVER_TABLES = ("stations", "riders", "payments", "trips")
GOLD_TABLES = ("dim_rider", "dim_station", "dim_date", "fact_trip", "fact_payment")

# --- fixed values: gold column lists in output order.
DIM_RIDER_COLUMNS = (
    "rider_id",
    "first",
    "last",
    "birthday",
    "account_start_date",
    "account_end_date",
    "is_member",
)
DIM_STATION_COLUMNS = ("station_id", "name", "latitude", "longitude")
DIM_DATE_COLUMNS = ("date_key", "date", "year", "quarter", "month", "day", "day_of_week")
FACT_TRIP_COLUMNS = (
    "trip_id",
    "rider_id",
    "start_station_id",
    "end_station_id",
    "start_date_key",
    "end_date_key",
    "rideable_type",
    "trip_duration_minutes",
    "rider_age_at_trip",
)
FACT_PAYMENT_COLUMNS = ("payment_id", "rider_id", "payment_date_key", "payment_amount")
