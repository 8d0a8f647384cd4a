"""CSV feeds, the catalog sink, and the audits."""

import os
import tempfile


from conftest import SF_SMALL
from lakemart.plans.lakehouse import materialize, read_csv_feeds
from lakemart.plans.silver import clean_stations, clean_trips
from lakemart.sources.catalog import count_sql
from lakemart.sources import csv_feed
from lakemart.sources.csv_feed import read_feed, write_feed
from lakemart.plans.registry import run_of, written_layers


def _write(dirname, name, text):
    path = os.path.join(dirname, name)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(text)
    return path




def test_csv_scan(spark):
    d = tempfile.mkdtemp(prefix="lakemart-csv-")
    path = _write(d, "stations", '0012,"Clark, Lake",41.886,-87.631\nS9,Plain,bad,1\n,No Id,1,2\nS8,Short\n')
    raw = read_feed(spark, path, "stations")
    assert raw.columns == ["_c0", "_c1", "_c2", "_c3"]
    got = {r.station_id: (r.name, r.latitude, r.longitude) for r in clean_stations(raw).collect()}
    assert got == {"0012": ("Clark, Lake", 41.886, -87.631), "S9": ("Plain", None, 1.0), "S8": ("Short", None, None)}


def test_csv_trips_bad_time_dropped(spark):
    d = tempfile.mkdtemp(prefix="lakemart-csv-")
    path = _write(d, "trips", "A,bike,2021-01-01 10:00:00,2021-01-01 10:10:00,1,2,7\n"
                              "B,bike,not-a-time,2021-01-01 10:10:00,1,2,7\n"
                              "C,bike,2021-01-01 10:00:00,2021-01-01 10:10:00,1,2,x\n")
    got = [(r.trip_id, r.trip_duration_minutes) for r in clean_trips(read_feed(spark, path, "trips")).collect()]
    assert got == [("A", 10.0)]


def test_csv_round_trip_of_landed_feeds(spark):
    W = written_layers(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="lakemart-rt-")
    paths = {}
    for name, df in W.raw.items():
        paths[name] = f"{d}/{name}"
        write_feed(df, paths[name])
    back = read_csv_feeds(spark, paths)
    for name in W.raw:
        assert sorted(map(tuple, back[name].collect()), key=str) == sorted(map(tuple, W.raw[name].collect()), key=str)


def test_catalog_layers_and_sql_counts(spark):
    W = written_layers(spark, SF_SMALL)
    loc = tempfile.mkdtemp(prefix="lakemart-cat-")
    C = materialize(spark, W.raw, location=loc, catalog=True)
    tables = {r.tableName for r in spark.sql("SHOW TABLES IN gold").collect()}
    assert {"dim_rider", "dim_station", "dim_date", "fact_trip", "fact_payment"} <= tables
    counts = {r.table_name: r.row_count for r in spark.sql(count_sql("gold", ["fact_trip", "dim_date"])).collect()}
    assert counts == {"gold.fact_trip": W.fact_trip.count(), "gold.dim_date": W.dim_date.count()}
    assert dict(spark.table("gold.fact_payment").dtypes)["payment_amount"] == "decimal(18,2)"
    assert C.fact_trip.count() == W.fact_trip.count()


def test_cli_runs_the_whole_flow(spark, capsys):
    from lakemart.cli import main
    from lakemart.plans.registry import csv_feed_paths

    paths = csv_feed_paths(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="lakemart-cli-")
    main([f"--{k}={v}" for k, v in paths.items()]
         + [f"--location={out}/lake", f"--out={out}/reports", "--show=3",
            "--reports=rides_by_year_month_dow,spend_and_rides_monthly"])
    printed = capsys.readouterr().out
    assert "== rides_by_year_month_dow" in printed and "gold.fact_trip" in printed
    assert "== bronze.trips" in printed
    W = written_layers(spark, SF_SMALL)
    r1 = spark.read.parquet(f"{out}/reports/rides_by_year_month_dow")
    from lakemart.plans import marts
    want = marts.REPORTS["rides_by_year_month_dow"](W)
    assert sorted(map(tuple, r1.collect())) == sorted(map(tuple, want.collect()))


def test_layers_in_another_table_format(spark):
    W = written_layers(spark, SF_SMALL)
    loc = tempfile.mkdtemp(prefix="lakemart-orc-")
    O = materialize(spark, W.raw, fmt="orc", location=loc, catalog=False)
    assert O.fact_trip.inputFiles()[0].endswith(".orc")
    for name in ("dim_rider", "fact_trip", "fact_payment"):
        assert sorted(map(tuple, O.gold[name].collect()), key=str) == \
            sorted(map(tuple, W.gold[name].collect()), key=str)


def test_landed_feeds_are_compressed_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_feed, "COMPRESSED_ROWS", 10)
    rows = [(str(i), f" name {i}, \"x\" ", None if i % 3 else "41.5", "-87.0") for i in range(95)]
    raw = spark.createDataFrame(rows, "_c0 string, _c1 string, _c2 string, _c3 string").coalesce(1)
    csv_feed.write_feed(raw, f"{tmp_path}/s", compression="gzip")
    files = [f for f in os.listdir(f"{tmp_path}/s") if f.startswith("part-")]
    assert len(files) == 10 and all(f.endswith(".csv.gz") for f in files)
    assert sorted(map(tuple, csv_feed.read_feed(spark, f"{tmp_path}/s", "stations").collect())) == sorted(rows)


def test_the_run_lands_compressed_feeds_and_joins_in_small_parts(spark):
    run = run_of(spark, SF_SMALL)
    files = [f for f in os.listdir(run.csv("trips").removeprefix("file:")) if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
