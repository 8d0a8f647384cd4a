"""Tables are replaced by swap, counted by their own writes; day sets travel as bitmaps."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, raw
from fixture_rows import PAYMENTS, RIDERS, STATIONS, TRIPS
from lakemart.functions.daymaps import day_words, days_of
from lakemart.plans.lakehouse import ALL_TABLES, lakehouse
from lakemart.plans.registry import QUERIES, run_of
from lakemart.sources.catalog import create_layers, table_location, write_table

ROWS = {"stations": STATIONS, "riders": RIDERS, "payments": PAYMENTS, "trips": TRIPS}


@pytest.fixture
def layer(spark, tmp_path):
    create_layers(spark, str(tmp_path), ["gold"], "swap_")
    yield "swap_gold"
    spark.sql("DROP SCHEMA swap_gold CASCADE")


def folders(tmp_path):
    return sorted(p for p in os.listdir(tmp_path / "gold.db") if not p.startswith("."))


def test_a_write_that_fails_half_way_leaves_the_old_table(spark, tmp_path, layer):
    write_table(spark.range(100), f"{layer}.t")
    at = table_location(spark, f"{layer}.t")
    bad = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("half way"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="half way"):
        write_table(bad, f"{layer}.t")
    assert spark.table(f"{layer}.t").count() == 100
    assert table_location(spark, f"{layer}.t") == at
    assert len(folders(tmp_path)) == 1  # nothing of the failed write stays


def test_a_replaced_table_leaves_one_folder(spark, tmp_path, layer):
    for n in (5, 7, 3):
        write_table(spark.range(n), f"{layer}.t")
        assert spark.table(f"{layer}.t").count() == n
        assert spark.sql(f"SELECT count(*) FROM {layer}.t").first()[0] == n
    assert len(folders(tmp_path)) == 1


def test_a_table_may_be_made_from_itself(spark, layer):
    write_table(spark.range(5), f"{layer}.t")
    write_table(spark.table(f"{layer}.t").union(spark.range(5, 8)), f"{layer}.t")
    assert spark.table(f"{layer}.t").count() == 8


def test_columns_and_format_may_change(spark, layer):
    write_table(spark.range(5), f"{layer}.t")
    write_table(spark.range(2).select("id", F.lit("x").alias("name")), f"{layer}.t")
    assert spark.table(f"{layer}.t").columns == ["id", "name"]
    write_table(spark.range(4), f"{layer}.t", "orc")
    assert spark.table(f"{layer}.t").count() == 4


def test_a_folder_outside_the_layer_is_never_deleted(spark, tmp_path, layer):
    own = str(tmp_path / "own")
    spark.range(9).write.parquet(own)
    spark.catalog.createTable(f"{layer}.t", path=own, source="parquet")
    write_table(spark.range(2), f"{layer}.t")
    assert spark.table(f"{layer}.t").count() == 2
    assert spark.read.parquet(own).count() == 9


def test_writes_count_their_rows(spark, tmp_path):
    feeds = {name: raw(spark, name, rows) for name, rows in ROWS.items()}
    house = lakehouse(spark, feeds, location=str(tmp_path), catalog=False)
    house.write(*ALL_TABLES)
    seen = house.rows_written()
    assert set(seen) == set(ALL_TABLES)
    for table, n in seen.items():
        assert house.table(table).count() == n, table


def test_writes_of_empty_feeds_count_nothing(spark, tmp_path):
    house = lakehouse(spark, {name: raw(spark, name, []) for name in ROWS}, location=str(tmp_path), catalog=False)
    house.write(*ALL_TABLES)
    assert set(house.rows_written().values()) == {0}


def test_write_audit_equals_the_counts_without_a_scan(spark):
    run = run_of(spark, SF_SMALL)
    run.house.write(*ALL_TABLES)
    audit = QUERIES["write_audit"](spark, SF_SMALL)
    assert "Scan parquet" not in audit._jdf.queryExecution().executedPlan().toString()
    counted = QUERIES["layer_row_counts"](spark, SF_SMALL)
    assert sorted(map(tuple, audit.collect())) == sorted(map(tuple, counted.collect()))


def test_day_sets_as_words(spark):
    days = [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(1970, 3, 4), dt.date(1970, 3, 5), dt.date(9999, 12, 31)]
    days += [dt.date(1967, 1, 1) + dt.timedelta(i) for i in range(500)]
    df = spark.createDataFrame([(d,) for d in [*days, None, *days]], "d date")
    assert sorted(r[0] for r in days_of(day_words(df)).collect()) == sorted(set(days))
    assert days_of(day_words(df.limit(0))).count() == 0


def test_the_date_dimension_shuffles_words(spark):
    plan = QUERIES["dim_date"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_bit_or" in plan[plan.index("Exchange hashpartitioning"):]  # words are made below the shuffle
    assert "SortAggregate" not in plan
