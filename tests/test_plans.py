"""Physical plan shape: pruning, pushdown, join strategy, shuffle count."""

from conftest import SF_SMALL
from lakemart.plans import marts as M
from lakemart.plans.lakehouse import build_layers
from lakemart.plans.registry import layers, written_layers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_reads_only_needed_columns_and_broadcasts_dates(spark):
    W = written_layers(spark, SF_SMALL)
    p = plan(M.rides_by_year_month_dow(W.fact_trip, W.dim_date))
    assert "ReadSchema: struct<start_date_key:bigint,trip_duration_minutes:double>" in p
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    # one hash shuffle (final aggregate) + the range shuffle of the sort
    assert p.count("Exchange hashpartitioning") == 1


def test_monthly_join_reuses_aggregation_partitioning(spark):
    W = written_layers(spark, SF_SMALL)
    p = plan(M.spend_and_rides_monthly(W.fact_trip, W.fact_payment, W.dim_date))
    # each side: one shuffle for its aggregate; the join on the same keys adds none
    assert p.count("Exchange hashpartitioning") == 2


def test_rider_reports_aggregate_before_joining(spark):
    W = written_layers(spark, SF_SMALL)
    p = plan(M.spend_by_rider(W.fact_payment, W.dim_rider))
    join_at = p.find("Join")
    assert "partial_sum" in p[join_at:]  # the partial aggregate sits below the join


def test_station_pairs_aggregate_before_joining(spark):
    W = written_layers(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a station dimension past any broadcast
        p = plan(M.rides_by_station_pair(W.fact_trip, W.dim_station))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [i for i in range(len(p)) if p.startswith("SortMergeJoin", i)]
    assert len(joins) == 2
    # between the scan of the trips and both joins there is their partial aggregate
    assert "partial_count" in p[joins[-1]:p.index("start_station_id", joins[-1]) + 4000]


def test_fact_trip_skips_unused_rider_join(spark):
    # built lazily, the rider dimension is the dedup aggregate, so Catalyst knows
    # rider_id is unique there and drops a left join none of whose columns is used
    L = build_layers(written_layers(spark, SF_SMALL).raw)
    p = plan(L.fact_trip.select("trip_id", "start_date_key"))
    assert "Join" not in p


def test_silver_not_null_filter_reaches_scan(spark):
    L = layers(spark, SF_SMALL)
    p = plan(L.silver["stations"])
    assert "PushedFilters: [IsNotNull(_c0)]" in p
