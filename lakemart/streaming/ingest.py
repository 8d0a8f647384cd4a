"""Incremental raw -> silver: the silver step over a landing folder of CSV files.

The source program re-reads whole files and overwrites its tables on every
run. At scale the same step can run incrementally: Structured Streaming's
file source picks up only CSV files that arrived since the last trigger, the
transformation is exactly the batch one (``plans.silver``), and the parquet
file sink with a checkpoint commits each micro-batch exactly once, so a lost
executor or a restarted driver resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakemart.plans.silver import CLEANERS
from lakemart.schemas import FEEDS

#: Files of one micro-batch: bounds the work of a batch and of its retry, not the data.
MAX_FILES = 1000


def read_feed_stream(spark: SparkSession, landing_dir: str, feed: str, max_files: int | None = None) -> DataFrame:
    """Streaming raw rows of ``feed`` from header-less CSV files in ``landing_dir``."""
    reader = spark.readStream.schema(FEEDS[feed].raw_schema()).option("header", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(landing_dir)


def start_silver_stream(
    spark: SparkSession,
    feed: str,
    landing_dir: str,
    silver_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files: int | None = MAX_FILES,
) -> StreamingQuery:
    """Start the silver step of ``feed`` as a stream into parquet at ``silver_dir``.

    ``available_now`` processes everything landed so far, in micro-batches of at
    most ``max_files`` files (None: all in one), and stops: a scheduled incremental run. Otherwise the
    query keeps running with ``processing_time`` triggers. ``checkpoint_dir``
    must be on shared storage."""
    silver = CLEANERS[feed](read_feed_stream(spark, landing_dir, feed, max_files))
    writer = (
        silver.writeStream.format("parquet")
        .option("path", silver_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_silver_increment(
    spark: SparkSession,
    feed: str,
    landing_dir: str,
    silver_dir: str,
    checkpoint_dir: str,
    max_files: int | None = MAX_FILES,
) -> DataFrame:
    """Process all newly landed files of ``feed`` and return the silver table."""
    query = start_silver_stream(spark, feed, landing_dir, silver_dir, checkpoint_dir, max_files=max_files)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(CLEANERS[feed](spark.createDataFrame([], FEEDS[feed].raw_schema())).schema).parquet(
        silver_dir
    )
