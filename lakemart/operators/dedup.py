"""Keep one row per key, the same row on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per ``key``: the smallest tuple of the other ``columns``.

    ``dropDuplicates([key])`` keeps whichever row a task sees first, so the
    dimension would change with the partitioning. ``min(struct(...))`` picks a
    deterministic row (fields compared left to right, NULLs first) and, being
    an aggregate, is combined map-side before the shuffle: a key that holds a
    third of all rows leaves each map task as a single row. A window with
    ``row_number`` would instead ship every row of the hot key to one task.
    """
    rest = [c for c in columns if c != key]
    picked = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])
