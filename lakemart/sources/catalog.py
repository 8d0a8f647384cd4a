"""Catalog layers (bronze / silver / gold), the overwrite sink, and listings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.schemas import LAYERS


def create_layers(spark: SparkSession, location: str | None = None, layers=LAYERS, prefix: str = "") -> None:
    """A2: CREATE SCHEMA IF NOT EXISTS for each layer, under ``location`` when
    given; ``prefix`` goes before the schemas' names."""
    for layer in layers:
        place = f"{location}/{layer}.db".replace("\\", "\\\\").replace("'", "\\'")
        where = f" LOCATION '{place}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{layer}{where}")


def write_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """A3-A5: replace ``table`` whole with ``df`` (the source program's only write mode).

    The rows go to a fresh folder beside the layer's other tables; only when all
    are written is the table pointed at it, and the folder it pointed at before
    is deleted (if it lies in the layer's own location). A write that fails, or a driver that is lost, leaves the old
    table as it was, and ``df`` may read the table it replaces. A written table
    also cuts the lineage: later layers plan from its files, and a lost executor
    costs a re-read, not a recomputation of the layers below."""
    spark = df.sparkSession
    layer, name = table.rsplit(".", 1)
    fresh = f"{spark.catalog.getDatabase(layer).locationUri.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    try:
        df.write.format(fmt).mode("errorifexists").save(fresh)
    except Exception:
        _delete(spark, fresh)
        raise
    before = table_location(spark, table) if spark.catalog.tableExists(table) else None
    point_at(spark, table, fmt, fresh)
    if before is not None and before != fresh and _within(spark, before, layer):
        _delete(spark, before)


def point_at(spark: SparkSession, table: str, fmt: str, folder: str) -> None:
    """Make ``table`` the rows under ``folder``: a new location if its columns and
    format stay, else a new definition. Catalog work only, no data is moved."""
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    found = spark.read.format(fmt).load(folder)
    if spark.catalog.tableExists(table):
        same = spark.table(table).schema == found.schema and table_details(spark, table).get("Provider") == fmt
        if same:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=folder, source=fmt, schema=found.schema)


def table_details(spark: SparkSession, table: str) -> dict[str, str]:
    """The table's entries in DESCRIBE EXTENDED (Location, Provider, Type, ...)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = [r["col_name"] for r in rows]
    start = names.index("# Detailed Table Information") if "# Detailed Table Information" in names else len(names)
    return {r["col_name"]: r["data_type"] for r in rows[start + 1 :]}


def table_location(spark: SparkSession, table: str) -> str | None:
    return table_details(spark, table).get("Location")


def _within(spark: SparkSession, folder: str, layer: str) -> bool:
    """Whether ``folder`` lies in the layer's location."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(spark.catalog.getDatabase(layer).locationUri).toUri().getPath().rstrip("/")
    return path(folder).toUri().getPath().startswith(f"{root}/")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def show_tables(spark: SparkSession, layer: str) -> DataFrame:
    """Namespace, tableName, isTemporary of the tables in ``layer``."""
    return spark.sql(f"SHOW TABLES IN {layer}")


def describe_tables(spark: SparkSession, layer: str, tables) -> DataFrame:
    """table_name, col_name, data_type, comment for each table of ``layer``."""
    parts = [
        spark.sql(f"DESCRIBE TABLE {layer}.{t}").select(
            F.lit(f"{layer}.{t}").alias("table_name"), "col_name", "data_type", "comment"
        )
        for t in tables
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_sql(layer: str, tables, prefix: str = "") -> str:
    """One SQL text, UNION ALL of single-table counts named ``layer.table``."""
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}.{t}' AS table_name, COUNT(*) AS row_count FROM {prefix}{layer}.{t}" for t in tables
    )
