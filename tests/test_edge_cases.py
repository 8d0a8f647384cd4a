"""The FIXTURES.md edge cases, on hand-made raw rows, with literal expectations."""

import datetime as dt
from decimal import Decimal

import pytest

from conftest import raw
from fixture_rows import PAYMENTS, RIDERS, STATIONS, TRIPS
from lakemart.plans import marts as M
from lakemart.plans.lakehouse import build_layers


@pytest.fixture(scope="module")
def L(spark):
    feeds = {
        "stations": raw(spark, "stations", STATIONS),
        "riders": raw(spark, "riders", RIDERS),
        "payments": raw(spark, "payments", PAYMENTS),
        "trips": raw(spark, "trips", TRIPS),
    }
    return build_layers(feeds)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_bad_keys_are_dropped_without_error(L):
    assert sorted(r.rider_id for r in L.silver["riders"].collect()) == [1, 2, 3, 4, 4]
    trip_ids = sorted(r.trip_id for r in L.silver["trips"].collect())
    assert trip_ids == ["T1", "T10", "T2", "T3", "T3", "T4", "T7", "T8", "T9"]  # same trip_id twice: both kept
    assert sorted(r.payment_id for r in L.silver["payments"].collect()) == [10, 11, 12, 13, 15, 16]


def test_bad_amount_or_date_keeps_the_payment(L):
    by_id = {r.payment_id: r for r in L.silver["payments"].collect()}
    assert by_id[11].amount is None and by_id[11].payment_date == dt.date(2021, 3, 6)
    assert by_id[12].payment_date is None and by_id[12].amount == Decimal("3.00")
    assert by_id[13].payment_date is None
    fp = {r.payment_id: r.payment_date_key for r in L.fact_payment.collect()}
    assert fp[12] is None and fp[10] == 20210305


def test_station_ids_keep_leading_zeros_and_dedup_is_deterministic(L):
    st = {r.station_id: (r.name, r.latitude, r.longitude) for r in L.dim_station.collect()}
    assert st["0012"] == ("Clark & Lake", 41.886, -87.631)
    assert st["S3"] == ("Alpha", 3.0, 4.0)
    assert len(st) == 4


def test_duplicate_rider_keeps_smallest_row(L):
    riders = {r.rider_id: r for r in L.dim_rider.collect()}
    assert set(riders) == {1, 2, 3, 4}
    assert riders[4].first == "Abe" and riders[4].is_member is True
    assert "address" not in L.dim_rider.columns


def test_durations_negative_zero_kept(L):
    minutes = {(r.trip_id, r.started_at.hour): r.trip_duration_minutes for r in L.silver["trips"].collect()}
    assert minutes[("T2", 10)] == -1.0
    assert minutes[("T3", 10)] == 0.0
    assert minutes[("T7", 12)] == 0.5


def test_ages_and_date_keys(L):
    ft = {(r.trip_id, r.start_date_key): r for r in L.fact_trip.collect()}
    assert ft[("T7", 20210228)].rider_age_at_trip == 29  # born Feb 29, trip Feb 28 of a common year
    assert ft[("T8", 20200227)].rider_age_at_trip == 29  # the day before the birthday
    assert ft[("T9", 20200228)].rider_age_at_trip == 30  # on the birthday
    assert ft[("T4", 20211231)].rider_age_at_trip is None  # unknown rider kept
    assert ft[("T4", 20211231)].end_date_key == 20220101  # crosses the year
    assert ft[("T10", 20210331)].end_date_key == 20210401  # crosses the month
    assert ft[("T10", 20210331)].rider_age_at_trip == 40


def test_dim_date_holds_all_observed_dates(L):
    dd = {r.date_key: r for r in L.dim_date.collect()}
    assert sorted(dd) == [20200227, 20200228, 20210228, 20210305, 20210306, 20210331,
                          20210401, 20210402, 20211231, 20220101]
    d = dd[20210305]
    assert (d.year, d.quarter, d.month, d.day, d.day_of_week) == (2021, 1, 3, 5, 6)  # a Friday
    assert dd[20210228].day_of_week == 1  # Sunday is 1


def test_rides_by_year_month_dow(L):
    assert rows(M.rides_by_year_month_dow(L.fact_trip, L.dim_date)) == [
        (2020, 2, 5, 1, 1.0, 1.0),
        (2020, 2, 6, 1, 1.0, 1.0),
        (2021, 2, 1, 1, 0.5, 0.5),
        (2021, 3, 4, 1, 2.0, 2.0),
        (2021, 3, 6, 4, 7.5, 30.0),
        (2021, 12, 6, 1, 20.0, 20.0),
    ]


def test_rides_by_hour(L):
    assert rows(M.rides_by_hour(L.silver["trips"])) == [
        (0, 1, 1.0), (10, 3, 9.67), (11, 1, 1.0), (12, 2, 0.75), (23, 2, 11.0),
    ]


def test_station_report_merges_names_and_keeps_unknowns(L):
    assert rows(M.rides_by_station_pair(L.fact_trip, L.dim_station)) == [
        ("Dup Name", "Dup Name", 5, 0.5),
        ("Dup Name", None, 2, 1.0),
        ("Alpha", "Alpha", 1, 20.0),
        ("Clark & Lake", "Dup Name", 1, 30.0),
    ]


def test_member_type_and_age(L):
    assert rows(M.rides_by_age_member(L.fact_trip, L.dim_rider)) == [
        ("casual", None, 1, 20.0),
        ("casual", 29, 3, 0.5),
        ("casual", 40, 1, 2.0),
        ("member", 29, 1, 1.0),
        ("member", 30, 1, 1.0),
        ("member", 31, 2, 14.5),
    ]


def test_payments_by_month_half_cent_rounds_up(L):
    assert rows(M.payments_by_month(L.fact_payment, L.dim_date)) == [
        (None, None, None, 2, Decimal("7.00"), Decimal("3.50")),
        (2021, 1, 3, 2, Decimal("12.50"), Decimal("12.50")),
        (2021, 2, 4, 2, Decimal("0.03"), Decimal("0.02")),
    ]


def test_spend_by_rider(L):
    assert rows(M.spend_by_rider(L.fact_payment, L.dim_rider)) == [
        (1, 24, Decimal("12.50")),
        (2, 24, Decimal("7.00")),
        (3, 33, Decimal("0.03")),
    ]


def test_monthly_report_is_driven_by_payments(L):
    assert rows(M.spend_and_rides_monthly(L.fact_trip, L.fact_payment, L.dim_date)) == [
        (2, None, None, Decimal("7.00"), 0, 0.0),  # no date: NULL month, never matches rides
        (1, 2021, 3, Decimal("12.50"), 2, 29.0),
        (3, 2021, 4, Decimal("0.03"), 0, 0.0),  # payment and no rides: 0 and 0
    ]


def test_payments_rollup_levels(L):
    got = {(r.year, r.quarter, r.month, r.grouping_level): (r.payment_count, r.total_amount)
           for r in M.payments_rollup(L.fact_payment, L.dim_date).collect()}
    assert got[(None, None, None, 7)] == (6, Decimal("19.53"))
    assert got[(2021, None, None, 3)] == (4, Decimal("12.53"))
    assert got[(2021, 1, None, 1)] == (2, Decimal("12.50"))
    assert got[(None, None, None, 0)] == (2, Decimal("7.00"))  # the NULL-date month row


def test_spend_vs_avg_rides(L):
    got = {r.rider_id: r for r in M.spend_vs_avg_rides(L.fact_trip, L.fact_payment, L.dim_date).collect()}
    assert got[1].months_paid == 1 and got[1].avg_rides_per_month == 2.0
    assert got[1].avg_minutes_per_month == 29.0 and got[1].avg_monthly_spend == Decimal("12.50")
    assert got[3].avg_rides_per_month == 0.0
