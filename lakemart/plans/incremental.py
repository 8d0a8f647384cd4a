"""Reports kept up to date: additive parts stored by day, renewed for the periods a batch touches.

A report's measures are sums (``operators.measures``), so the parts of a day add
up over the batches that brought its rows. The store holds one row for each
(day, batch, keys), a partition a period (a month, unless told otherwise: a day's
parts alone are too little for a file). A batch is reduced to its parts (map-side
combined), the stored parts of just the touched periods are read (partition
pruning), the batch's own earlier parts there are dropped, and the periods'
partitions are replaced by dynamic partition overwrite. So a late row renews its
own period only, a replayed batch changes nothing, and a report reads parts,
never facts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import Measure, aggregate
from lakemart.session import scratch_dir

#: The stored day of rows without one.
NO_DAY = -1
#: Date keys of one period: the last two digits, a month.
MONTH = 100


@dataclass(frozen=True)
class DailyParts:
    """Parts of ``measure`` by ``day`` (a date key column of the facts) and
    further fact columns ``keys``, as Parquet under ``folder``; ``span`` date keys
    (1 a day, 100 a month, 10000 a year) are one partition."""

    folder: str
    day: str
    measure: Measure
    keys: tuple[str, ...] = ()
    span: int = MONTH

    def _schema(self, facts: DataFrame) -> DataFrame:
        return self._reduced(facts.limit(0), "")

    def _reduced(self, facts: DataFrame, batch: str) -> DataFrame:
        day = F.coalesce(F.col(self.day), F.lit(NO_DAY)).cast("long").alias("_day")
        parts = aggregate(facts, [day, *self.keys], self.measure)
        return parts.select(
            *self.keys, *[name for name, _ in self.measure.parts], F.lit(batch).alias("_batch"), "_day", F.floor(F.col("_day") / self.span).alias("_period")
        )

    def _stored(self, spark: SparkSession, like: DataFrame) -> DataFrame:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return spark.createDataFrame([], like.schema)
        return spark.read.schema(like.schema).parquet(self.folder)

    def apply(self, facts: DataFrame, batch: str) -> None:
        """Add the rows of one batch. The same ``batch`` again replaces what it
        brought before in the periods it touches now."""
        spark = facts.sparkSession
        staged = f"{scratch_dir(spark, 'daily-parts')}-{uuid.uuid4().hex[:8]}"
        new = self._reduced(facts, batch)
        new.write.parquet(f"{staged}/new")
        new = spark.read.schema(new.schema).parquet(f"{staged}/new")
        touched = new.select("_period").distinct()
        others = self._stored(spark, new).where(F.col("_batch") != batch).join(touched, "_period", "left_semi").select(*new.columns)
        # written apart first: a partition is never read while it is replaced
        others.unionByName(new).write.parquet(f"{staged}/renewed")
        renewed = spark.read.schema(new.schema).parquet(f"{staged}/renewed")
        # one task a period, so that a period is one file
        writer = renewed.repartition("_period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_period").parquet(self.folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(staged)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def parts(self, spark: SparkSession, facts: DataFrame) -> DataFrame:
        """The stored parts, with the day under its own name (NULL for rows
        without one). ``facts`` gives the columns' types."""
        like = self._schema(facts)
        day = F.when(F.col("_day") != NO_DAY, F.col("_day")).alias(self.day)
        return self._stored(spark, like).select(day, *self.keys, *[name for name, _ in self.measure.parts])

    def report(
        self, spark: SparkSession, facts: DataFrame, group: Sequence[str], measures: Sequence[str],
        dim_date: DataFrame | None = None, extra: Sequence[Column] = (),
    ) -> DataFrame:
        """``measures`` by ``group``: attributes of ``dim_date`` (joined to the
        parts, a row for each day and key, not to the facts) and stored keys."""
        rows = self.parts(spark, facts)
        if dim_date is not None:
            attrs = [g for g in group if g in dim_date.columns]
            dates = dim_date.select("date_key", *attrs)
            rows = rows.join(dates, rows[self.day] == dates["date_key"], "left")
        merged = aggregate(rows, [F.col(g) for g in group], self.measure, merge=True)
        return merged.select(*group, *self.measure.final(measures)).orderBy(*group)
