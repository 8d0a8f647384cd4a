"""Kept and dropped rows of the silver step in one pass, with every reason.

The silver step drops a row whose required keys are not all there. Here the same
decision writes both kinds of rows: kept ones typed, dropped ones as they came,
as two partitions of one output, so that dropped rows can be seen, repaired and
sent again. Map-side only; each task writes at most one file of either kind, both
open at once (``spark.sql.maxConcurrentOutputFileWriters``): rows pass through and
are not sorted by verdict first, so a task's memory doesn't grow with its rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.standardize import typed_columns
from lakemart.schemas import FeedSpec
from lakemart.session import apply_runtime_conf

#: Values of the output's partition column.
VERDICT, KEPT, QUARANTINED = "verdict", "kept", "quarantined"


def reasons(spec: FeedSpec) -> Column:
    """All reasons to drop a row that holds its raw and its typed fields: for each
    required key, in the layout's order, ``<key> missing`` or ``<key> unreadable``."""
    raw_of = dict(zip([name for name, _ in spec.columns], spec.raw_names))
    found = [
        F.when(F.col(raw_of[key]).isNull(), F.lit(f"{key} missing")).when(F.col(key).isNull(), F.lit(f"{key} unreadable"))
        for key in spec.required
    ]
    return F.array_compact(F.array(*found))


def judged(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """Every raw row with its typed fields, ``reasons`` (empty for a kept row) and ``verdict``."""
    both = raw.select(*spec.raw_names, *typed_columns(spec))
    why = both.select("*", reasons(spec).alias("reasons"))
    return why.select("*", F.when(F.size("reasons") == 0, F.lit(KEPT)).otherwise(F.lit(QUARANTINED)).alias(VERDICT))


def write_judged(raw: DataFrame, spec: FeedSpec, folder: str, extra: dict[str, Column] | None = None) -> None:
    """One pass over ``raw``: kept rows' typed fields, and dropped rows' raw
    fields and reasons, as the partitions ``verdict=kept`` and
    ``verdict=quarantined`` of ``folder`` (replaced whole). ``extra`` adds
    columns to the kept rows, computed from typed ones."""
    apply_runtime_conf(raw.sparkSession)
    rows = judged(raw, spec)
    kept = F.col(VERDICT) == KEPT
    names = [name for name, _ in spec.columns]
    typed = [F.when(kept, F.col(n)).alias(n) for n in names]
    derived = [F.when(kept, c).alias(n) for n, c in (extra or {}).items()]
    as_landed = [F.when(~kept, F.col(r)).alias(r) for r in spec.raw_names]
    out = rows.select(*typed, *derived, *as_landed, "reasons", VERDICT)
    out.write.mode("overwrite").partitionBy(VERDICT).parquet(folder)


def _schema(spec: FeedSpec, extra_types: dict[str, str]) -> str:
    typed = [f"`{n}` {t}" for n, t in (*spec.columns, *extra_types.items())]
    return ", ".join([*typed, *(f"`{r}` string" for r in spec.raw_names), "reasons array<string>", f"{VERDICT} string"])


def read_kept(spark: SparkSession, spec: FeedSpec, folder: str, extra_types: dict[str, str] | None = None) -> DataFrame:
    """The silver rows of ``write_judged``; only their partition is read."""
    names = [n for n, _ in spec.columns] + list(extra_types or {})
    found = spark.read.schema(_schema(spec, extra_types or {})).parquet(folder)
    return found.where(F.col(VERDICT) == KEPT).select(*names)


def read_quarantined(spark: SparkSession, spec: FeedSpec, folder: str, extra_types: dict[str, str] | None = None) -> DataFrame:
    """feed, the raw fields, reasons of the dropped rows; only their partition is read."""
    found = spark.read.schema(_schema(spec, extra_types or {})).parquet(folder)
    rows = found.where(F.col(VERDICT) == QUARANTINED)
    return rows.select(F.lit(spec.name).alias("feed"), *spec.raw_names, "reasons")


def repaired(quarantined: DataFrame, spec: FeedSpec, fixes: dict[str, Column]) -> DataFrame:
    """Quarantined rows as raw rows again, with ``fixes`` (raw name -> new text)
    applied: input for another silver step."""
    return quarantined.select(*[fixes.get(r, F.col(r)).alias(r) for r in spec.raw_names])


def union_wide(parts: Iterable[DataFrame], width: int) -> DataFrame:
    """Rows of several feeds under one another; raw fields past a feed's width are NULL."""
    out = None
    for part in parts:
        missing = [F.lit(None).cast(T.StringType()).alias(f"_c{i}") for i in range(width) if f"_c{i}" not in part.columns]
        part = part.select("*", *missing)
        out = part if out is None else out.unionByName(part)
    return out
