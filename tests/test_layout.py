"""Same results for any partitioning, and the eager plans equal the plain ones."""

import pytest
from pyspark.sql import functions as F

from conftest import raw
from fixture_rows import PAYMENTS, RIDERS, STATIONS, TRIPS
from lakemart.functions import member_type
from lakemart.operators import join_then_aggregate, ride_measure
from lakemart.plans import marts as M
from lakemart.plans.lakehouse import build_layers
from lakemart.plans.registry import written_layers
from conftest import SF_SMALL

ROWS = {"stations": STATIONS, "riders": RIDERS, "payments": PAYMENTS, "trips": TRIPS}


def _reports(L):
    return {
        "r1": M.rides_by_year_month_dow(L.fact_trip, L.dim_date),
        "r3": M.rides_by_station_pair(L.fact_trip, L.dim_station),
        "r4": M.rides_by_age_member(L.fact_trip, L.dim_rider),
        "r5": M.payments_by_month(L.fact_payment, L.dim_date),
        "r9": M.spend_and_rides_monthly(L.fact_trip, L.fact_payment, L.dim_date),
        "dim_rider": L.dim_rider.orderBy("rider_id"),
        "dim_station": L.dim_station.orderBy("station_id"),
    }


@pytest.mark.parametrize("parts", [1, 5])
def test_partitioning_does_not_change_results(spark, parts):
    base = {n: raw(spark, n, r) for n, r in ROWS.items()}
    # reversed input order and a different partition count
    shuffled = {n: raw(spark, n, list(reversed(r))).repartition(parts) for n, r in ROWS.items()}
    a = {k: [tuple(x) for x in v.collect()] for k, v in _reports(build_layers(base)).items()}
    b = {k: [tuple(x) for x in v.collect()] for k, v in _reports(build_layers(shuffled)).items()}
    assert a == b


def test_eager_rider_plan_equals_plain_join(spark):
    W = written_layers(spark, SF_SMALL)
    m = ride_measure()
    eager = M.rides_by_age_member(W.fact_trip, W.dim_rider)
    riders = W.dim_rider.select(F.col("rider_id").alias("_rid"), "is_member")
    plain = join_then_aggregate(
        W.fact_trip.withColumnRenamed("rider_age_at_trip", "age"), "rider_id", riders, "_rid",
        [member_type("is_member").alias("member_type"), F.col("age").alias("rider_age_at_trip")], m,
    ).select("member_type", "rider_age_at_trip", *m.final(("ride_count", "avg_trip_minutes")))
    assert sorted(map(tuple, eager.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_spend_by_rider_equals_join_then_group(spark):
    W = written_layers(spark, SF_SMALL)
    ours = M.spend_by_rider(W.fact_payment, W.dim_rider)
    r = W.dim_rider.select(F.col("rider_id").alias("_rid"), "birthday", "account_start_date")
    plain = (
        W.fact_payment.join(r, F.col("rider_id") == F.col("_rid"), "left")
        .groupBy("rider_id", F.floor(F.months_between("account_start_date", "birthday") / 12).alias("age"))
        .agg(F.round(F.sum("payment_amount"), 2).cast("decimal(38,2)").alias("total"))
    )
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_report_totals_match_the_facts(spark):
    W = written_layers(spark, SF_SMALL)
    n_trips = W.fact_trip.count()
    for df in (M.rides_by_year_month_dow(W.fact_trip, W.dim_date),
               M.rides_by_station_pair(W.fact_trip, W.dim_station),
               M.rides_by_age_member(W.fact_trip, W.dim_rider),
               M.rides_by_hour(W.silver["trips"])):
        assert df.agg(F.sum("ride_count")).first()[0] == n_trips
    total = W.fact_payment.agg(F.sum("payment_amount")).first()[0]
    assert M.payments_by_month(W.fact_payment, W.dim_date).agg(F.sum("total_amount")).first()[0] == total
    assert M.spend_by_rider(W.fact_payment, W.dim_rider).agg(F.sum("total_amount")).first()[0] == total


def test_dimension_keys_unique_and_fact_dates_covered(spark):
    W = written_layers(spark, SF_SMALL)
    for dim, key in ((W.dim_rider, "rider_id"), (W.dim_station, "station_id"), (W.dim_date, "date_key")):
        assert dim.count() == dim.select(key).distinct().count()
    for fact, key in ((W.fact_trip, "start_date_key"), (W.fact_trip, "end_date_key"),
                      (W.fact_payment, "payment_date_key")):
        missing = fact.where(F.col(key).isNotNull()).join(W.dim_date, F.col(key) == F.col("date_key"), "left_anti")
        assert missing.count() == 0


def test_shuffle_width_does_not_change_results(spark):
    W = written_layers(spark, SF_SMALL)
    names = ("rides_by_year_month_dow", "rides_by_station_pair", "payments_by_month",
             "spend_and_rides_monthly", "spend_vs_avg_rides", "payments_rollup")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = {}
    try:
        for width in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            got[width] = {n: [tuple(r) for r in M.REPORTS[n](W).collect()] for n in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got["1"] == got["13"]  # same rows in the same order
