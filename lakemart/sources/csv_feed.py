"""Header-less CSV feeds: read by position as text, write as landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.schemas import FEEDS, FeedSpec


def _spec(feed: FeedSpec | str) -> FeedSpec:
    return FEEDS[feed] if isinstance(feed, str) else feed


def read_feed(spark: SparkSession, path: str, feed: FeedSpec | str) -> DataFrame:
    """A1: raw rows ``_c0.._cN`` of one feed, every column as text.

    An explicit all-string schema instead of ``inferSchema``: no extra pass
    over the files (which at scale is a full read), no type that depends on
    the data, and ids such as ``0012`` keep their leading zeros. Malformed
    lines are kept (PERMISSIVE); empty and missing trailing fields become NULL and the
    silver step decides what survives. The files are split and read in
    parallel (``spark.sql.files.maxPartitionBytes`` per task).
    """
    spec = _spec(feed)
    return (
        spark.read.schema(spec.raw_schema())
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


#: Name of the scan's column that holds a line whose number of fields is not the layout's.
DAMAGED = "_line"


def read_feed_with_damage(spark: SparkSession, path: str, feed: FeedSpec | str) -> DataFrame:
    """The raw rows of ``read_feed`` with ``_line``: the text of a line that has
    more or fewer fields than the layout (NULL for all others).

    ``read_feed`` drops a surplus without a trace and fills what is missing with
    NULL; here the same scan hands the whole line on, in the same pass. The row
    still holds the fields that the layout has a place for."""
    spec = _spec(feed)
    schema = T.StructType([*spec.raw_schema(), T.StructField(DAMAGED, T.StringType(), True)])
    return (
        spark.read.schema(schema)
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", DAMAGED)
        .option("columnPruning", False)  # else only the fields asked for are counted
        .csv(path)
    )


def field_count(line: Column) -> Column:
    """The number of fields of a CSV line: delimiters outside quoted fields, and one.

    A field is quoted if it begins with a quote; within, a backslash takes the
    next character as it is. Each such field is cut out, then commas are counted."""
    bare = F.regexp_replace(line, r'(^|,)"(?:[^"\\]|\\.)*+"', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def damaged_lines(spark: SparkSession, path: str, feed: FeedSpec | str) -> DataFrame:
    """feed, line, n_fields, n_expected, first_field: the lines of one feed whose
    number of fields is not the layout's. Map-side only."""
    spec = _spec(feed)
    # true for every line that is there; names a second column, as Spark refuses to
    # count rows of a scan of which nothing but the damaged line is read
    there = F.length(F.concat(F.col(DAMAGED), F.coalesce("_c0", F.lit("")))) >= 0
    rows = read_feed_with_damage(spark, path, spec).where(there)
    return rows.select(
        F.lit(spec.name).alias("feed"),
        F.col(DAMAGED).alias("line"),
        field_count(F.col(DAMAGED)).alias("n_fields"),
        F.lit(spec.width).alias("n_expected"),
        F.col("_c0").alias("first_field"),
    )


#: Rows in one compressed file, which a single task reads.
COMPRESSED_ROWS = 1_000_000


def write_feed(raw: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Write raw text rows as header-less CSV (overwrite), one file per task,
    white space at the ends of values kept. The rows may have any number of columns.
    Compressed files (``gzip``) can't be split for reading, so a task writes one
    for each ``COMPRESSED_ROWS`` rows."""
    writer = raw.write.mode(mode).option("header", False).option("compression", compression)
    if compression != "none":
        writer = writer.option("maxRecordsPerFile", COMPRESSED_ROWS)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
