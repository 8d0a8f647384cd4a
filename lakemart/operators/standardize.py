"""Positional rename + typed projection + required-key filter (raw -> silver)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import typed
from lakemart.schemas import FeedSpec


def typed_columns(spec: FeedSpec) -> list[Column]:
    """``_cN`` text -> silver name and type; bad text becomes NULL."""
    return [
        (F.col(raw) if spark_type == "string" else typed(raw, spark_type)).alias(name)
        for raw, (name, spark_type) in zip(spec.raw_names, spec.columns)
    ]


def required_present(keys) -> Column:
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(key).isNotNull()
    return cond


def rejected(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """feed, missing_key, row_count: the rows that ``standardize`` drops, by the
    first required key that is absent or unreadable. Combined map-side."""
    first = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(k)) for k in spec.required])
    typed_rows = raw.select(*typed_columns(spec)).select(first.alias("missing_key")).where(F.col("missing_key").isNotNull())
    counted = typed_rows.groupBy("missing_key").agg(F.count("*").alias("row_count"))
    return counted.select(F.lit(spec.name).alias("feed"), "missing_key", "row_count")


def standardize(raw: DataFrame, spec: FeedSpec, extra: dict[str, Column] | None = None) -> DataFrame:
    """Typed silver rows of one feed.

    One narrow pass, no shuffle. Raw keys that are absent are filtered in the
    scan (``IsNotNull`` reaches it). Keys that are cast are then tested on their
    typed values; the typed row goes through ``inline``, which Catalyst does not
    move a filter below, so that each cast runs once a row and not again in the
    filter. ``extra`` adds derived columns (computed from the typed ones).
    """
    types = dict(spec.columns)
    raw_of = dict(zip(types, spec.raw_names))
    present = raw.where(required_present([raw_of[k] for k in spec.required]))
    cast = [k for k in spec.required if types[k] != "string"]
    columns = typed_columns(spec)
    if cast:
        out = present.select(F.inline(F.array(F.struct(*columns)))).where(required_present(cast))
    else:
        out = present.select(*columns)
    for name, expr in (extra or {}).items():
        out = out.withColumn(name, expr)
    return out
