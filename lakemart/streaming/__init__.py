"""Structured Streaming form of the silver step, the trip fact and the rider dimension."""

from lakemart.streaming.gold import run_dim_rider_increment, run_fact_trip_increment
from lakemart.streaming.ingest import read_feed_stream, run_silver_increment, start_silver_stream

__all__ = [
    "read_feed_stream",
    "run_dim_rider_increment",
    "run_fact_trip_increment",
    "run_silver_increment",
    "start_silver_stream",
]
