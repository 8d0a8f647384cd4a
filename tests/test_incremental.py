"""Reports kept up to date by batches equal the reports over all facts."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakemart.operators import payment_measure, ride_measure
from lakemart.plans import marts as M
from lakemart.plans.incremental import DailyParts
from lakemart.plans.registry import written_layers
from lakemart.sources.testfeeds import arrivals


@pytest.fixture(scope="module")
def W(spark):
    return written_layers(spark, SF_SMALL)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_batches_with_late_rows_in_any_order(spark, W, tmp_path):
    batches = arrivals(W.fact_trip, "start_date_key", "trip_id")
    assert sum(b.count() for b in batches) == W.fact_trip.count() and all(b.count() for b in batches)
    for n, order in enumerate(([0, 1, 2], [2, 0, 1])):
        store = DailyParts(f"{tmp_path}/{n}", "start_date_key", ride_measure())
        for i in order:
            store.apply(batches[i], f"b{i}")
        got = store.report(spark, W.fact_trip, ["date"], M.RIDE_AVG_TOTAL, W.dim_date)
        assert rows(got) == rows(M.rides_by_day(W.fact_trip, W.dim_date))


def test_a_replayed_batch_changes_nothing(spark, W, tmp_path):
    store = DailyParts(str(tmp_path / "s"), "payment_date_key", payment_measure())
    batches = arrivals(W.fact_payment, "payment_date_key", "payment_id")
    for i in (0, 1, 1, 2, 0, 2):
        store.apply(batches[i], f"b{i}")
    got = store.report(spark, W.fact_payment, ["year", "quarter", "month"], M.PAYMENT_MEASURES, W.dim_date)
    assert rows(got) == rows(M.payments_by_month(W.fact_payment, W.dim_date))


def test_only_touched_periods_are_written(spark, W, tmp_path):
    store = DailyParts(str(tmp_path / "s"), "start_date_key", ride_measure())
    store.apply(W.fact_trip, "all")
    folder = tmp_path / "s"
    before = {p: sorted(os.listdir(folder / p)) for p in os.listdir(folder) if p.startswith("_period")}
    day = W.fact_trip.agg(F.min("start_date_key")).first()[0]
    store.apply(W.fact_trip.where(F.col("start_date_key") == day), "late")
    after = {p: sorted(os.listdir(folder / p)) for p in before}
    assert [p for p in before if before[p] != after[p]] == [f"_period={day // 100}"]


def test_further_keys_and_other_periods(spark, W, tmp_path):
    m = ride_measure()
    for span in (1, 10000):
        few = W.fact_trip.where(F.col("start_date_key") % 10 == 1) if span == 1 else W.fact_trip
        store = DailyParts(f"{tmp_path}/{span}", "start_date_key", m, ("rideable_type",), span)
        store.apply(few, "b")
        got = store.report(spark, few, ["rideable_type"], M.RIDE_AVG)
        want = few.groupBy("rideable_type").agg(*m.partial()).select("rideable_type", *m.final(M.RIDE_AVG)).orderBy("rideable_type")
        assert rows(got) == rows(want)


def test_an_empty_store_gives_no_rows(spark, W, tmp_path):
    store = DailyParts(str(tmp_path / "none"), "start_date_key", ride_measure())
    assert store.report(spark, W.fact_trip, ["date"], M.RIDE_AVG, W.dim_date).count() == 0
    store.apply(W.fact_trip.limit(0), "empty")
    assert store.report(spark, W.fact_trip, ["date"], M.RIDE_AVG, W.dim_date).count() == 0


def test_reports_read_parts_not_facts(spark, W, tmp_path):
    store = DailyParts(str(tmp_path / "s"), "start_date_key", ride_measure())
    store.apply(W.fact_trip, "all")
    plan = store.report(spark, W.fact_trip, ["date"], M.RIDE_AVG, W.dim_date)._jdf.queryExecution().executedPlan().toString()
    assert "fact_trip" not in plan
