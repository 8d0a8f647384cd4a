"""The whole run: raw feeds -> silver -> gold, as lazy plans or written as tables (catalog or folders)."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart.plans import gold as G
from lakemart.plans.silver import CLEANERS
from lakemart.schemas import GOLD_TABLES, SILVER_TABLES
from lakemart.session import apply_runtime_conf
from lakemart.sources.catalog import create_layers, write_table
from lakemart.sources.csv_feed import read_feed


class Lazy(Mapping[str, DataFrame]):
    """Name -> DataFrame, each built on first access and then reused."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __contains__(self, name: object) -> bool:
        return name in self._builders

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


@dataclass(frozen=True)
class Layers:
    raw: Mapping[str, DataFrame]
    silver: Mapping[str, DataFrame]
    gold: Mapping[str, DataFrame]

    def __getattr__(self, name: str) -> DataFrame:
        for layer in (self.gold, self.silver):
            if name in layer:
                return layer[name]
        raise AttributeError(name)


#: Every silver and gold table: its step, and the tables that the step reads.
STEPS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    **{f"silver.{name}": (CLEANERS[name], (f"bronze.{name}",)) for name in SILVER_TABLES},
    "gold.dim_rider": (G.dim_rider, ("silver.riders",)),
    "gold.dim_station": (G.dim_station, ("silver.stations",)),
    "gold.dim_date": (G.dim_date, ("silver.trips", "silver.payments")),
    "gold.fact_trip": (G.fact_trip, ("silver.trips", "gold.dim_rider")),
    "gold.fact_payment": (G.fact_payment, ("silver.payments",)),
}
ALL_TABLES = (*(f"bronze.{name}" for name in SILVER_TABLES), *STEPS)


def _inputs(table: str) -> tuple[str, ...]:
    return STEPS[table][1] if table in STEPS else ()


def step(table: str, get: Callable[[str], DataFrame]) -> DataFrame:
    """The plan of one silver or gold table over its inputs, as ``get`` gives them."""
    build, inputs = STEPS[table]
    return build(*map(get, inputs))


def waves(tables: Iterable[str]) -> list[list[str]]:
    """``tables`` and all they are made from, in groups that need only earlier groups."""
    needed: dict[str, None] = {}
    open_ = list(tables)
    while open_:
        name = open_.pop()
        needed[name] = None
        open_ += _inputs(name)
    done: set[str] = set()
    out = []
    while len(done) < len(needed):
        out.append([name for name in needed if name not in done and done.issuperset(_inputs(name))])
        done.update(out[-1])
    return out


def _layers(get: Callable[[str], DataFrame]) -> Layers:
    """Layers whose tables ``get`` gives by their full name."""

    def layer(name: str, tables: Iterable[str]) -> Lazy:
        return Lazy({t: (lambda full=f"{name}.{t}": get(full)) for t in tables})

    return Layers(layer("bronze", SILVER_TABLES), layer("silver", SILVER_TABLES), layer("gold", GOLD_TABLES))


def build_layers(raw: Mapping[str, DataFrame]) -> Layers:
    """All layers as lazy plans: a table's plan is built when first asked for,
    and nothing is run or written."""
    built: Layers = _layers(lambda table: step(table, get))

    def get(table: str) -> DataFrame:
        layer, name = table.split(".")
        return raw[name] if layer == "bronze" else getattr(built, layer)[name]

    return Layers(raw, built.silver, built.gold)


def read_csv_feeds(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Raw feeds from header-less CSV files: {feed name: path}."""
    return {name: read_feed(spark, path, name) for name, path in paths.items()}


class Lakehouse:
    """Bronze, silver and gold tables that are written when first asked for,
    after the tables they are made from and no others.

    Each table is planned from the written tables it reads (facts from the
    written dimensions), so every write cuts the lineage and a lost executor
    costs a re-read, not a recomputation of the layers below. Tables that do not
    depend on each other are written concurrently: a small table's job does not
    wait behind a large one. ``write`` writes what it is given and returns the
    written table."""

    def __init__(self, raw: Mapping[str, DataFrame], write: Callable[[str, DataFrame], DataFrame]):
        self._raw = raw
        self._write = write
        self._rows: dict[str, int] = {}
        self._tables: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def _land(self, table: str) -> DataFrame:
        layer, name = table.split(".")
        rows = self._raw[name] if layer == "bronze" else step(table, self._tables.__getitem__)
        seen = Observation()
        out = self._write(table, rows.observe(seen, F.count(F.lit(1)).alias("rows")))
        self._rows[table] = seen.get["rows"]
        return out

    def write(self, *tables: str) -> None:
        """Write those of ``tables`` and their ancestors that are not written yet."""
        with self._lock:
            for wave in waves(tables):
                new = [t for t in wave if t not in self._tables]
                if new:
                    with ThreadPoolExecutor(max_workers=len(new)) as pool:
                        self._tables.update(zip(new, pool.map(self._land, new), strict=True))

    def table(self, table: str) -> DataFrame:
        self.write(table)
        return self._tables[table]

    def written(self) -> set[str]:
        return set(self._tables)

    def rows_written(self) -> dict[str, int]:
        """Rows of each written table, counted by the write itself as they
        passed (``DataFrame.observe``): no second scan."""
        with self._lock:
            return dict(self._rows)

    def layers(self) -> Layers:
        """The written tables, each written on first access."""
        return _layers(self.table)

    def steps(self) -> Layers:
        """Each silver and gold table recomputed (lazily) from the *written*
        tables it reads: the work of one step of the run, as a plan."""
        plans = _layers(lambda table: step(table, self.table) if table in STEPS else self.table(table))
        return Layers(plans.raw, plans.silver, plans.gold)


def lakehouse(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    fmt: str = "parquet",
    location: str | None = None,
    catalog: bool = True,
    prefix: str = "",
) -> Lakehouse:
    """A lakehouse over the raw feeds; nothing is written yet but the schemas.

    ``catalog=True`` writes ``bronze.*``, ``silver.*``, ``gold.*`` catalog
    tables (schemas under ``location`` when given, else the warehouse; a
    schema that already exists keeps its own location); ``catalog=False``
    writes plain ``fmt`` folders ``location/layer/name``. ``prefix`` goes before
    the schemas' names. A table that exists is replaced whole."""
    apply_runtime_conf(spark)
    if catalog:
        create_layers(spark, location, prefix=prefix)
    elif not location:
        raise ValueError("a location is needed when not writing catalog tables")

    def write(table: str, df: DataFrame) -> DataFrame:
        if catalog:
            write_table(df, f"{prefix}{table}", fmt)
            return spark.table(f"{prefix}{table}")
        path = f"{location}/{table.replace('.', '/')}"
        df.write.format(fmt).mode("overwrite").save(path)
        return spark.read.format(fmt).load(path)

    return Lakehouse(raw, write)


def materialize(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    fmt: str = "parquet",
    location: str | None = None,
    catalog: bool = True,
    prefix: str = "",
) -> Layers:
    """Write all bronze, silver and gold tables (see ``lakehouse``) and return
    layers that read the written tables."""
    house = lakehouse(spark, raw, fmt, location, catalog, prefix)
    house.write(*ALL_TABLES)
    return house.layers()
