"""Gold tables kept by streams: the trip fact joined to the rider dimension, and
the rider dimension itself by keyed state.

Both write through ``foreachBatch`` under the batch's number, by dynamic
partition overwrite: a batch that is run again after a failure replaces its own
rows and nothing else, so every landed row is in the table exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.plans import gold as G
from lakemart.plans.silver import CLEANERS
from lakemart.schemas import DIM_RIDER_COLUMNS, FACT_TRIP_COLUMNS, FEEDS
from lakemart.streaming.ingest import MAX_FILES, read_feed_stream

BATCH = "batch_id"


def write_batch(rows: DataFrame, batch_id: int, folder: str) -> None:
    """``rows`` as the batch's partition of ``folder``, in place of what it held."""
    out = rows.select("*", F.lit(batch_id).cast("long").alias(BATCH))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(folder)


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint_dir: str, mode: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_dir).outputMode(mode)
    return writer.trigger(availableNow=True).start()


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _empty_silver(spark: SparkSession, feed: str) -> DataFrame:
    return CLEANERS[feed](spark.createDataFrame([], FEEDS[feed].raw_schema()))


def run_fact_trip_increment(
    spark: SparkSession,
    landing_dir: str,
    riders: Callable[[], DataFrame],
    fact_dir: str,
    checkpoint_dir: str,
    max_files: int | None = MAX_FILES,
) -> DataFrame:
    """T8, J1 as a stream: all newly landed trip files cleaned, joined to the
    rider dimension and written; returns the fact table.

    ``riders`` gives the dimension as it is when a batch runs, so a batch sees
    riders that were added since the last one; the join is planned batch by
    batch, like the batch job's (broadcast if small, else sort-merge with skewed
    partitions split). A trip keeps the age known when its batch ran."""
    trips = CLEANERS["trips"](read_feed_stream(spark, landing_dir, "trips", max_files))

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(G.fact_trip(batch, riders()), batch_id, fact_dir)

    _finish(_run(trips, each, checkpoint_dir, "append"))
    return read_fact_trip(spark, fact_dir)


def read_fact_trip(spark: SparkSession, fact_dir: str) -> DataFrame:
    schema = G.fact_trip(_empty_silver(spark, "trips"), G.dim_rider(_empty_silver(spark, "riders"))).schema
    return spark.read.schema(schema.add(BATCH, "long")).parquet(fact_dir).select(*FACT_TRIP_COLUMNS)


def run_dim_rider_increment(
    spark: SparkSession,
    landing_dir: str,
    dim_dir: str,
    checkpoint_dir: str,
    max_files: int | None = MAX_FILES,
) -> DataFrame:
    """G7 on a stream: one row per rider, the smallest, whatever the order in
    which files arrive; returns the dimension.

    The state is one row a rider: the smallest seen so far (a streaming
    ``min(struct)``, combined map-side before its shuffle). Each batch hands on
    the riders whose row it met, as changes under its number; the dimension is
    the latest change of each rider. For many riders keep the state on disk
    (``spark.sql.streaming.stateStore.providerClass`` = RocksDB's)."""
    riders = CLEANERS["riders"](read_feed_stream(spark, landing_dir, "riders", max_files))
    rest = [c for c in DIM_RIDER_COLUMNS if c != "rider_id"]
    smallest = riders.groupBy("rider_id").agg(F.min(F.struct(*rest)).alias("_row"))
    changes = smallest.select("rider_id", *[F.col(f"_row.{c}").alias(c) for c in rest])

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, dim_dir)

    _finish(_run(changes, each, checkpoint_dir, "update"))
    return read_dim_rider(spark, dim_dir)


def read_dim_rider(spark: SparkSession, dim_dir: str) -> DataFrame:
    """The latest change of each rider."""
    rest = [c for c in DIM_RIDER_COLUMNS if c != "rider_id"]
    schema = G.dim_rider(_empty_silver(spark, "riders")).schema
    changes = spark.read.schema(schema.add(BATCH, "long")).parquet(dim_dir)
    latest = changes.groupBy("rider_id").agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("_row"))
    return latest.select("rider_id", *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*DIM_RIDER_COLUMNS)
