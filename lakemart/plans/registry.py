"""Every data product by name: ``(spark, sf_dir) -> DataFrame`` over the test tables.

The run is a lakehouse, as in the source program: the raw feeds are derived
from the parquet tables in ``sf_dir`` (``sources.testfeeds``) and landed as
header-less CSV files; bronze is the scan of those, and silver and gold follow,
each from the written layer below, as catalog tables in schemas made for the run
under the session's shared scratch folder. A table is written once per (Spark
application, ``sf_dir``, state of its files), when a product first needs it, with
only the tables it is made from. The run's folder goes with the application.

A product is then one step of the run, as a lazy plan:

* ``clean_*``: the silver step over the written bronze feed;
* ``dim_*``, ``fact_*``: the gold step over the written silver tables (facts
  over the written dimensions);
* reports: over the written gold tables (and silver trips for the hour of day).
"""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import payment_measure, read_quarantined, rejected, ride_measure, union_wide, write_judged
from lakemart.plans import marts as M
from lakemart.plans.incremental import DailyParts
from lakemart.plans.lakehouse import ALL_TABLES, Layers, Lazy, lakehouse, read_csv_feeds
from lakemart.schemas import FEEDS, GOLD_TABLES, SILVER_TABLES
from lakemart.session import apply_runtime_conf, scratch_dir
from lakemart.sources.catalog import count_sql
from lakemart.sources.csv_feed import damaged_lines, read_feed, write_feed
from lakemart.sources.testfeeds import arrivals, damaged_feed, raw_feeds
from lakemart.streaming import run_dim_rider_increment, run_fact_trip_increment, run_silver_increment

Query = Callable[[SparkSession, str], DataFrame]

# The given tables that the feeds are derived from.
INPUT_TABLES = ("supplier", "nation", "customer", "orders", "lineitem", "events")

# Callers may run products from several threads.
_LOCK = threading.RLock()


def _run_key(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """The application, the folder and the state of the input tables in it
    (files, bytes and latest change of each), so that a run is written anew when
    its input has changed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    state = []
    for name in INPUT_TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            state.append("-")
            continue
        files, size, latest = 0, 0, 0
        found = fs.listFiles(path, True)
        while found.hasNext():
            f = found.next()
            files, size, latest = files + 1, size + f.getLen(), max(latest, f.getModificationTime())
        state.append(f"{files}/{size}/{latest}")
    return spark.sparkContext.applicationId, _full(sf_dir), ",".join(state)


def _full(sf_dir: str) -> str:
    return sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)


class Run:
    """The CSV files and the lakehouse of one application and input."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        apply_runtime_conf(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self.folder = scratch_dir(spark, "run")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        self.prefix = f"run{uuid.uuid4().hex[:10]}_"
        landed = Lazy({name: (lambda n=name: read_feed(spark, self.csv(n), n)) for name in SILVER_TABLES})
        self.house = lakehouse(spark, landed, location=self.folder, prefix=self.prefix)
        self._csv: dict[str, str] = {}
        self._locks = {name: threading.Lock() for name in SILVER_TABLES}

    def fresh(self, purpose: str) -> str:
        """A new folder of the run."""
        return f"{self.folder}/{purpose}-{uuid.uuid4().hex[:12]}"

    def csv(self, feed: str) -> str:
        """The feed's folder of (compressed) header-less CSV files, the form the run takes as input."""
        with self._locks[feed]:
            if feed not in self._csv:
                path = f"{self.folder}/raw/{feed}"
                write_feed(raw_feeds(self.spark, self.sf_dir)[feed], path, compression="gzip")
                self._csv[feed] = path
            return self._csv[feed]


_RUNS: dict[tuple[str, str, str], Run] = {}


def run_of(spark: SparkSession, sf_dir: str) -> Run:
    """The run over the tables in ``sf_dir`` as they are now."""
    key = _run_key(spark, sf_dir)
    with _LOCK:
        if key not in _RUNS:
            _RUNS[key] = Run(spark, sf_dir)
        return _RUNS[key]


def written_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Bronze, silver and gold, each table written on first access."""
    apply_runtime_conf(spark)
    return run_of(spark, sf_dir).house.layers()


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Per-step plans: each table computed from the written layer below."""
    apply_runtime_conf(spark)
    return run_of(spark, sf_dir).house.steps()


def _step(product: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: product(layers(spark, sf_dir))


def _report(product: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: product(written_layers(spark, sf_dir))


# ------------------------------------------------------------ landing and catalog products

RAW_WIDTH = max(spec.width for spec in FEEDS.values())


def csv_feed_paths(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The run's four feeds as folders of header-less CSV files."""
    run = run_of(spark, sf_dir)
    return {name: run.csv(name) for name in SILVER_TABLES}


def raw_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan the four header-less CSV feeds by position, all columns as text.

    Returns every landed row: feed name and ``_c0.._c7`` (NULL past a feed's
    width)."""
    landed = read_csv_feeds(spark, csv_feed_paths(spark, sf_dir))
    out = None
    for name in SILVER_TABLES:
        df = landed[name]
        cols = [F.col(c) for c in df.columns]
        cols += [F.lit(None).cast("string").alias(f"_c{i}") for i in range(len(cols), RAW_WIDTH)]
        part = df.select(F.lit(name).alias("feed"), *cols)
        out = part if out is None else out.unionByName(part)
    return out


def clean_trips_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver trips produced by the streaming silver step over the CSV feed:
    every landed file, processed incrementally into a fresh sink."""
    run = run_of(spark, sf_dir)
    trips_csv = run.csv("trips")
    out = run.fresh("stream")
    return run_silver_increment(spark, "trips", trips_csv, f"{out}/trips", f"{out}/_checkpoint")


def fact_trip_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip fact kept by a stream: every landed trip file cleaned, joined to
    the written rider dimension batch by batch, and written under the batch's number."""
    run = run_of(spark, sf_dir)
    run.house.write("gold.dim_rider")
    out = run.fresh("stream-fact")
    return run_fact_trip_increment(spark, run.csv("trips"), lambda: run.house.table("gold.dim_rider"), f"{out}/fact_trip", f"{out}/_checkpoint")


def dim_rider_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rider dimension kept by a stream's keyed state over every landed rider file."""
    run = run_of(spark, sf_dir)
    out = run.fresh("stream-rider")
    return run_dim_rider_increment(spark, run.csv("riders"), f"{out}/dim_rider", f"{out}/_checkpoint")


def csv_damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the four feeds with more or fewer fields than the layout, found
    in the scan of feeds some of whose lines are damaged on purpose."""
    run = run_of(spark, sf_dir)
    out, folder = None, run.fresh("damaged")
    for name in SILVER_TABLES:
        for part in damaged_feed(read_feed(spark, run.csv(name), name)):
            write_feed(part, f"{folder}/{name}", mode="append")
        found = damaged_lines(spark, f"{folder}/{name}", name)
        out = found if out is None else out.unionByName(found)
    return out


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the silver step drops, as they came, with every reason: written
    apart from the kept ones in one pass over each feed."""
    run = run_of(spark, sf_dir)
    bronze, folder, found = run.house.layers().raw, run.fresh("judged"), []
    for name in SILVER_TABLES:
        write_judged(bronze[name], FEEDS[name], f"{folder}/{name}")
        found.append(read_quarantined(spark, FEEDS[name], f"{folder}/{name}"))
    raw_fields = [f"_c{i}" for i in range(RAW_WIDTH)]
    return union_wide(found, RAW_WIDTH).select("feed", *raw_fields, F.array_join("reasons", "; ").alias("reasons"))


def write_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table, counted by the writes themselves."""
    run = run_of(spark, sf_dir)
    run.house.write(*ALL_TABLES)
    return spark.createDataFrame(sorted(run.house.rows_written().items()), "table_name string, row_count long")


def _kept_up(run: Run, fact: str, day: str, key: str, measure) -> tuple[DailyParts, DataFrame]:
    """A store of daily parts of a written fact, brought up to date by three
    batches, the last of which holds late rows of all days."""
    facts = run.house.table(f"gold.{fact}")
    store = DailyParts(run.fresh(f"parts-{fact}"), day, measure)
    for n, batch in enumerate(arrivals(facts, day, key)):
        store.apply(batch, f"batch-{n}")
    return store, facts


def rides_by_day_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rides_by_day`` from parts stored by day, after three batches."""
    run = run_of(spark, sf_dir)
    store, facts = _kept_up(run, "fact_trip", "start_date_key", "trip_id", ride_measure())
    return store.report(spark, facts, ["date"], M.RIDE_AVG_TOTAL, run.house.table("gold.dim_date"))


def rides_by_year_month_dow_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rides_by_year_month_dow`` from parts stored by day, after three batches."""
    run = run_of(spark, sf_dir)
    store, facts = _kept_up(run, "fact_trip", "start_date_key", "trip_id", ride_measure())
    return store.report(spark, facts, ["year", "month", "day_of_week"], M.RIDE_AVG_TOTAL, run.house.table("gold.dim_date"))


def payments_by_month_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``payments_by_month`` from parts stored by day, after three batches."""
    run = run_of(spark, sf_dir)
    store, facts = _kept_up(run, "fact_payment", "payment_date_key", "payment_id", payment_measure())
    return store.report(spark, facts, ["year", "quarter", "month"], M.PAYMENT_MEASURES, run.house.table("gold.dim_date"))


def catalog_run(spark: SparkSession, sf_dir: str, tables: Iterable[str]) -> str:
    """``tables`` written; the prefix of the run's schemas. They are made for the
    run: a user's own ``gold`` schema is never touched."""
    apply_runtime_conf(spark)
    run = run_of(spark, sf_dir)
    run.house.write(*tables)
    return run.prefix


def gold_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold tables of the run's catalog counted with one SQL text."""
    prefix = catalog_run(spark, sf_dir, [f"gold.{t}" for t in GOLD_TABLES])
    return spark.sql(count_sql("gold", GOLD_TABLES, prefix))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the silver step drops, by feed and first missing key."""
    bronze = written_layers(spark, sf_dir).raw
    out = None
    for name in SILVER_TABLES:
        part = rejected(bronze[name], FEEDS[name])
        out = part if out is None else out.unionByName(part)
    return out


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per bronze, silver and gold table of the run's catalog, by one SQL text."""
    prefix = catalog_run(spark, sf_dir, ALL_TABLES)
    audits = (("bronze", SILVER_TABLES), ("silver", SILVER_TABLES), ("gold", GOLD_TABLES))
    return spark.sql("\nUNION ALL\n".join(count_sql(layer, tables, prefix) for layer, tables in audits))


# ------------------------------------------------------------ registry

QUERIES: dict[str, Query] = {
    # R1, the flagship
    "rides_by_year_month_dow": _report(M.REPORTS["rides_by_year_month_dow"]),
    # silver step
    "clean_stations": _step(lambda L: L.silver["stations"]),
    "clean_riders": _step(lambda L: L.silver["riders"]),
    "clean_payments": _step(lambda L: L.silver["payments"]),
    "clean_trips": _step(lambda L: L.silver["trips"]),
    # gold step
    "dim_rider": _step(lambda L: L.dim_rider),
    "dim_station": _step(lambda L: L.dim_station),
    "dim_date": _step(lambda L: L.dim_date),
    "fact_trip": _step(lambda L: L.fact_trip),
    "fact_payment": _step(lambda L: L.fact_payment),
    # reports R2-R9 and the variants V1-V7, over the written gold tables
    **{name: _report(fn) for name, fn in M.REPORTS.items() if name != "rides_by_year_month_dow"},
    # landing, catalog and audits
    "raw_csv_scan": raw_csv_scan,
    "clean_trips_streamed": clean_trips_streamed,
    "layer_row_counts": layer_row_counts,
    "gold_row_counts": gold_row_counts,
    "rejected_rows": rejected_rows,
    # damage, quarantine, audits of writes
    "csv_damaged_lines": csv_damaged_lines,
    "quarantined_rows": quarantined_rows,
    "write_audit": write_audit,
    # kept up to date by batches and streams
    "rides_by_day_incremental": rides_by_day_incremental,
    "rides_by_year_month_dow_incremental": rides_by_year_month_dow_incremental,
    "payments_by_month_incremental": payments_by_month_incremental,
    "fact_trip_streamed": fact_trip_streamed,
    "dim_rider_streamed": dim_rider_streamed,
}
