"""A rider with a third of all trips: the trip fact's join is split, the reports combine map-side."""

from pyspark.sql import functions as F

from lakemart.plans import gold as G
from lakemart.plans import marts as M
from lakemart.session import scratch_dir

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",  # pretend the rider dimension is large
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _trips(spark, n=6000):
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0  # one rider holds a third of all trips
    rider = F.when(hot, F.lit(7)).otherwise((F.col("id") % 500 + 100).cast("int"))
    start = F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 37)
    return ids.select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("trip_id"),
        F.lit("classic").alias("rideable_type"),
        start.alias("started_at"),
        (start + F.expr("INTERVAL 10 MINUTES")).alias("ended_at"),
        (F.col("id") % 9).cast("string").alias("start_station_id"),
        (F.col("id") % 11).cast("string").alias("end_station_id"),
        rider.alias("rider_id"),
        F.lit(10.0).alias("trip_duration_minutes"),
    )


def _riders(spark):
    return spark.range(0, 700).select(
        F.col("id").cast("int").alias("rider_id"),
        F.lit("A").alias("first"), F.lit("B").alias("last"),
        F.date_add(F.lit("1980-01-01").cast("date"), (F.col("id") % 5000).cast("int")).alias("birthday"),
        F.lit("2015-01-01").cast("date").alias("account_start_date"),
        F.lit(None).cast("date").alias("account_end_date"),
        (F.col("id") % 2 == 0).alias("is_member"),
    )


def test_hot_rider_join_is_split_and_complete(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        trips, riders = _trips(spark), _riders(spark)
        # as in a run: the dimension is written first and the fact joins the written table
        dim_path = scratch_dir(spark, "skew-test") + "/dim_rider"
        G.dim_rider(riders).write.parquet(dim_path)
        dim = spark.read.parquet(dim_path)
        fact = G.fact_trip(trips, dim)
        rows = fact.collect()  # runs the DataFrame's own plan, which AQE then finalizes
        final = fact._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert "SortMergeJoin(skew=true)" in final
        assert len(rows) == 6000  # whole result: nothing dropped or capped
        assert sum(1 for r in rows if r.rider_id == 7) == 2000
        report = M.rides_by_age_member(fact, dim)
        assert report.agg(F.sum("ride_count")).first()[0] == 6000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
