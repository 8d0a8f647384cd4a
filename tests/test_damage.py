"""Lines whose number of fields is not the layout's are found with their text; dropped rows are kept apart with reasons."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, raw
from fixture_rows import PAYMENTS, RIDERS, STATIONS, TRIPS
from lakemart.operators import read_kept, read_quarantined, repaired, write_judged
from lakemart.plans.registry import QUERIES, run_of
from lakemart.plans.silver import CLEANERS
from lakemart.schemas import FEEDS, SILVER_TABLES
from lakemart.sources import damaged_lines, read_feed, read_feed_with_damage
from lakemart.sources.csv_feed import field_count

ROWS = {"stations": STATIONS, "riders": RIDERS, "payments": PAYMENTS, "trips": TRIPS}


def test_lines_with_more_or_fewer_fields_are_found(spark, tmp_path):
    lines = ["1,A,2.0,3.0", "1,A,2.0,3.0,EXTRA", "2,B", "3,,,", '4,"x, y",1.0,2.0', '5,"x, y",1.0,2.0,"p, q"', "6", "7,é,1.0,2.0,"]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    found = {(r["line"], r["n_fields"], r["first_field"]) for r in damaged_lines(spark, str(tmp_path), "stations").collect()}
    want = [(lines[1], 5, "1"), (lines[2], 2, "2"), (lines[5], 5, "5"), (lines[6], 1, "6"), (lines[7], 5, "7")]
    assert found == set(want)
    # the scan itself is unchanged, and the same scan with damage holds the same rows
    plain = read_feed(spark, str(tmp_path), "stations")
    marked = read_feed_with_damage(spark, str(tmp_path), "stations")
    assert sorted(map(str, plain.collect())) == sorted(map(str, marked.drop("_line").collect()))
    assert plain.count() == len(lines)


@pytest.mark.parametrize("line, n", [("", 1), (",", 2), ('"a,b"', 1), ('"a,b",', 2), ('"a\\",b",c', 2), ('a"b,c"d', 2), ('"",""', 2), (",,,", 4), ('"' + "x," * 5000 + '"', 1)])
def test_field_count(spark, line, n):
    assert spark.createDataFrame([(line,)], "l string").select(field_count(F.col("l"))).first()[0] == n


def test_a_feed_without_damage_has_none(spark):
    run = run_of(spark, SF_SMALL)
    for name in SILVER_TABLES:
        assert damaged_lines(spark, run.csv(name), name).count() == 0


def _judge(spark, name, rows, folder):
    write_judged(raw(spark, name, rows), FEEDS[name], folder)
    return read_kept(spark, FEEDS[name], folder), read_quarantined(spark, FEEDS[name], folder)


@pytest.mark.parametrize("name", SILVER_TABLES)
def test_quarantined_plus_silver_equals_bronze(spark, tmp_path, name):
    kept, dropped = _judge(spark, name, ROWS[name], f"{tmp_path}/{name}")
    assert kept.count() + dropped.count() == len(ROWS[name])
    columns = [c for c, _ in FEEDS[name].columns]
    silver = CLEANERS[name](raw(spark, name, ROWS[name])).select(*columns)
    assert sorted(map(str, kept.collect())) == sorted(map(str, silver.collect()))
    assert {tuple(r)[1:-1] for r in dropped.collect()} <= set(ROWS[name])


def test_every_reason_is_given(spark, tmp_path):
    rows = [("1", "2020-01-01", "1.00", "7"), (None, "2020-01-01", "1.00", "x"), ("y", None, None, None), ("2", "bad", "bad", "8")]
    kept, dropped = _judge(spark, "payments", rows, f"{tmp_path}/p")
    assert {r["payment_id"] for r in kept.collect()} == {1, 2}
    got = {r["_c0"]: r["reasons"] for r in dropped.collect()}
    assert got == {None: ["payment_id missing", "rider_id unreadable"], "y": ["payment_id unreadable", "rider_id missing"]}


def test_repaired_rows_pass(spark, tmp_path):
    rows = [("1", "2020-01-01", "1.00", "rider 7"), ("2", "2020-01-01", "1.00", "8")]
    _, dropped = _judge(spark, "payments", rows, f"{tmp_path}/p")
    again = repaired(dropped, FEEDS["payments"], {"_c3": F.replace(F.col("_c3"), F.lit("rider "), F.lit(""))})
    assert [r["rider_id"] for r in CLEANERS["payments"](again).collect()] == [7]


def test_empty_feed_has_both_partitions_empty(spark, tmp_path):
    kept, dropped = _judge(spark, "stations", [], f"{tmp_path}/s")
    assert kept.count() == dropped.count() == 0


def test_judged_rows_are_not_sorted_by_verdict(spark, tmp_path):
    spark.sql(f"CREATE TABLE judged_unsorted (n LONG, verdict STRING) USING parquet PARTITIONED BY (verdict) LOCATION '{tmp_path}/t'")
    write = "EXPLAIN INSERT INTO judged_unsorted SELECT id, IF(id % 2 = 0, 'kept', 'quarantined') FROM range(10)"
    try:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "0")
        assert "Sort [" in spark.sql(write).first()[0]
        rows = [(str(i) if i % 3 else "x", "2020-01-01", "1.00", "8") for i in range(300)]
        kept, dropped = _judge(spark, "payments", rows, f"{tmp_path}/p")
        assert (kept.count(), dropped.count()) == (200, 100)
        assert "Sort [" not in spark.sql(write).first()[0]
    finally:
        spark.sql("DROP TABLE judged_unsorted")


def test_quarantine_reads_its_partition_only(spark):
    plan = QUERIES["quarantined_rows"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(verdict" in plan and "(verdict" in plan


def test_quarantine_of_the_run_adds_up(spark):
    run = run_of(spark, SF_SMALL)
    L = run.house.layers()
    dropped = {r["feed"]: r["count"] for r in QUERIES["quarantined_rows"](spark, SF_SMALL).groupBy("feed").count().collect()}
    for name in SILVER_TABLES:
        assert L.raw[name].count() == L.silver[name].count() + dropped.get(name, 0)
