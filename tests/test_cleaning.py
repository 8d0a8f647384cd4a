"""Cleaning keeps every readable row, and says what it drops."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakemart.functions import minutes_rounded
from lakemart.operators import rejected
from lakemart.plans import gold as G
from lakemart.plans.lakehouse import ALL_TABLES, materialize, waves
from lakemart.plans.registry import QUERIES, Run
from lakemart.plans.silver import CLEANERS
from lakemart.schemas import FEEDS
from lakemart.session import apply_runtime_conf
from lakemart.sources.catalog import count_sql
from lakemart.sources.csv_feed import read_feed, write_feed
from lakemart.streaming import run_silver_increment

from conftest import SF_SMALL, raw

RIDER = ["Ann", "Lee", "Elm St", "1980-01-01", "2020-01-01", None, "true"]


def test_ids_as_decimals_and_past_32_bits_survive(spark):
    texts = ["7", "7.0", "3000000000", " 8 ", "1.5", "x", "", None, "99999999999999999999"]
    kept = CLEANERS["riders"](raw(spark, "riders", [(t, *RIDER) for t in texts]))
    assert sorted(r["rider_id"] for r in kept.collect()) == [1, 7, 7, 8, 3_000_000_000]


def test_large_amounts_survive(spark):
    rows = CLEANERS["payments"](raw(spark, "payments", [("1", "2020-01-01", "100000000.00", "7"), ("2", "2020-01-01", "n/a", "7.0")])).collect()
    assert [str(r["amount"]) for r in rows] == ["100000000.00", "None"]


def test_rejected_rows_and_kept_rows_are_all_rows(spark):
    rows = [("1", None, None, "7"), ("x", None, None, "y"), ("2", None, None, "y"), (None, None, None, "7"), ("3.0", None, None, "8")]
    feed = raw(spark, "payments", rows)
    lost = {r["missing_key"]: r["row_count"] for r in rejected(feed, FEEDS["payments"]).collect()}
    assert lost == {"payment_id": 2, "rider_id": 1}
    assert CLEANERS["payments"](feed).count() + sum(lost.values()) == len(rows)


def test_far_future_dates_keep_their_keys(spark):
    trips = CLEANERS["trips"](raw(spark, "trips", [("t", "b", "250000-01-02 00:00:00", "250000-01-02 01:00:00", None, None, "7")]))
    payments = CLEANERS["payments"](raw(spark, "payments", [("1", "+300000-01-01", "1.00", "7"), ("2", "300000-01-01", "1.00", "7")]))
    riders = G.dim_rider(CLEANERS["riders"](raw(spark, "riders", [("7", *RIDER)])))
    keys = G.fact_trip(trips, riders).select("start_date_key").collect()
    assert [r[0] for r in keys] == [2_500_000_102]
    dated = {r[0] for r in G.fact_payment(payments).select("payment_date_key").collect()} - {None}
    assert dated <= {3_000_000_101}
    assert {r[0] for r in G.dim_date(trips, payments).select("date_key").collect()} >= {2_500_000_102} | dated


def test_settings_of_the_session_do_not_change_results(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    apply_runtime_conf(spark)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    with pytest.raises(Exception, match="OVERFLOW"):
        spark.range(1).select(minutes_rounded(F.lit(10**17))).collect()


def test_changed_input_gives_changed_results(spark, tmp_path):
    folder = tmp_path / "sf"
    folder.mkdir()
    for given in sorted(Path(SF_SMALL).iterdir()):  # contents only: the given files may be read-only
        shutil.copyfile(given, folder / given.name)
    first = QUERIES["clean_stations"](spark, str(folder)).count()
    suppliers = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    more = suppliers.union(suppliers.select((F.col("s_suppkey") + 1001).alias("s_suppkey"), *suppliers.columns[1:])).toPandas()
    more.to_parquet(folder / "supplier.parquet")
    assert QUERIES["clean_stations"](spark, str(folder)).count() > first


def test_a_product_writes_only_what_it_is_made_from(spark):
    run = Run(spark, SF_SMALL)
    run.house.steps().silver["stations"]
    assert run.house.written() == {"bronze.stations"}
    run.house.layers().gold["dim_rider"]
    assert run.house.written() == {"bronze.stations", "bronze.riders", "silver.riders", "gold.dim_rider"}
    assert waves(["gold.fact_trip"])[-1] == ["gold.fact_trip"]
    assert {t for wave in waves(ALL_TABLES) for t in wave} == set(ALL_TABLES)


def test_csv_keeps_quotes_commas_and_spaces_and_empty_is_missing(spark, tmp_path):
    rows = [("1", 'a "b", c', "", " x "), ("2", None, '"', ","), ("", "", None, "é;'")]
    write_feed(raw(spark, "stations", rows), f"{tmp_path}/stations")
    found = read_feed(spark, f"{tmp_path}/stations", "stations").collect()
    want = [tuple(value or None for value in row) for row in rows]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_catalog_in_a_folder_with_an_apostrophe(spark, tmp_path):
    feeds = {"stations": [("1", "A", "1", "2")], "riders": [("7", *RIDER)], "payments": [("1", "2020-01-01", "1.00", "7")],
             "trips": [("t", "b", "2020-01-02 00:00:00", "2020-01-02 01:00:00", "1", "1", "7")]}
    frames = {name: raw(spark, name, rows) for name, rows in feeds.items()}
    materialize(spark, frames, location=f"{tmp_path}/it's", prefix="apostrophe_")
    assert {r["row_count"] for r in spark.sql(count_sql("bronze", list(feeds), "apostrophe_")).collect()} == {1}


def test_stream_reads_files_in_bounded_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i in range(6):
        (landing / f"{i}.csv").write_text(f"{i},2020-01-01,1.00,7\n")
    out = run_silver_increment(spark, "payments", str(landing), str(tmp_path / "silver"), str(tmp_path / "ck"), max_files=2)
    assert out.count() == 6
    assert len(list((tmp_path / "ck" / "commits").glob("[0-9]*"))) >= 3


def test_rollup_expands_months_not_facts(spark):
    plan = QUERIES["payments_rollup"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    expand = plan.index("Expand")
    assert "Aggregate" in plan[expand:]
