"""The streamed fact and dimension equal the batch ones, and survive replays."""

import os
from pathlib import Path

from pyspark.sql import functions as F

from conftest import raw
from fixture_rows import RIDERS, TRIPS
from lakemart.plans import gold as G
from lakemart.plans.silver import CLEANERS
from lakemart.streaming import run_dim_rider_increment, run_fact_trip_increment
from lakemart.streaming.gold import read_fact_trip, write_batch


def land(folder: Path, name: str, rows) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(",".join("" if v is None else v for v in r) + "\n" for r in rows))


def rows(df):
    return sorted(map(str, df.collect()))


def dims(spark, riders):
    return G.dim_rider(CLEANERS["riders"](raw(spark, "riders", riders)))


def test_fact_stream_equals_the_batch_fact(spark, tmp_path):
    riders = dims(spark, RIDERS)
    want = G.fact_trip(CLEANERS["trips"](raw(spark, "trips", TRIPS)), riders)
    landing = tmp_path / "in"
    for i, part in enumerate((TRIPS[:3], TRIPS[3:7])):
        land(landing, f"{i}.csv", part)
    where = (str(landing), lambda: riders, str(tmp_path / "fact"), str(tmp_path / "ck"))
    run_fact_trip_increment(spark, *where, max_files=1)
    land(landing, "2.csv", TRIPS[7:])
    got = run_fact_trip_increment(spark, *where, max_files=1)
    assert rows(got) == rows(want)
    # nothing new: nothing changes
    assert rows(run_fact_trip_increment(spark, *where)) == rows(want)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """A driver lost after the write and before the commit runs its batch again."""
    riders = dims(spark, RIDERS)
    landing, ck = tmp_path / "in", tmp_path / "ck"
    land(landing, "0.csv", TRIPS[:5])
    land(landing, "1.csv", TRIPS[5:])
    where = (str(landing), lambda: riders, str(tmp_path / "fact"), str(ck))
    before = rows(run_fact_trip_increment(spark, *where, max_files=1))
    last = max(int(p) for p in os.listdir(ck / "commits") if p.isdigit())
    for p in (ck / "commits" / str(last), ck / "commits" / f".{last}.crc"):
        p.unlink(missing_ok=True)
    assert rows(run_fact_trip_increment(spark, *where, max_files=1)) == before


def test_a_batch_replaces_its_own_rows_only(spark, tmp_path):
    facts = G.fact_trip(CLEANERS["trips"](raw(spark, "trips", TRIPS)), dims(spark, RIDERS))
    out = str(tmp_path / "fact")
    write_batch(facts, 0, out)
    write_batch(facts.limit(1), 1, out)
    write_batch(facts.limit(2), 1, out)
    assert read_fact_trip(spark, out).count() == facts.count() + 2


def test_riders_added_later_are_seen_by_later_batches(spark, tmp_path):
    known = [dims(spark, RIDERS[:0])]
    landing = tmp_path / "in"
    where = (str(landing), lambda: known[0], str(tmp_path / "fact"), str(tmp_path / "ck"))
    land(landing, "0.csv", TRIPS)
    first = run_fact_trip_increment(spark, *where)
    assert first.where(F.col("rider_age_at_trip").isNotNull()).count() == 0
    known[0] = dims(spark, RIDERS)
    land(landing, "1.csv", TRIPS)
    both = run_fact_trip_increment(spark, *where)
    assert both.where(F.col("rider_age_at_trip").isNotNull()).count() > 0


def test_rider_stream_does_not_depend_on_the_order_of_files(spark, tmp_path):
    more = [(r[0], "Zoe", *r[2:]) for r in RIDERS] + [(r[0], "Abe", *r[2:]) for r in RIDERS[::2]]
    everything = [*RIDERS, *more]
    want = rows(dims(spark, everything))
    thirds = [everything[0::3], everything[1::3], everything[2::3]]
    for n, order in enumerate(([0, 1, 2], [2, 0, 1])):
        base = tmp_path / str(n)
        base.mkdir()
        for i in order:  # a run a file: the state is carried on
            land(base / "in", f"{i}.csv", thirds[i])
            got = run_dim_rider_increment(spark, str(base / "in"), str(base / "dim"), str(base / "ck"))
        assert rows(got) == want
