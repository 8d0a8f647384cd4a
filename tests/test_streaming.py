"""The streaming silver step picks up new files only and equals the batch step."""

import os
import tempfile

from conftest import raw
from fixture_rows import TRIPS
from lakemart.plans.silver import clean_trips
from lakemart.streaming import run_silver_increment


def _land(dirname, name, rows):
    with open(os.path.join(dirname, name), "w") as f:
        for r in rows:
            f.write(",".join("" if v is None else v for v in r) + "\n")


def test_incremental_runs_process_each_file_once(spark):
    base = tempfile.mkdtemp(prefix="lakemart-stream-")
    landing = os.path.join(base, "landing")
    os.makedirs(landing)
    sink, ckpt = os.path.join(base, "silver"), os.path.join(base, "_checkpoint")
    first, second = TRIPS[:6], TRIPS[6:]
    _land(landing, "a.csv", first)
    out = run_silver_increment(spark, "trips", landing, sink, ckpt)
    assert out.count() == clean_trips(raw(spark, "trips", first)).count()
    _land(landing, "b.csv", second)
    out = run_silver_increment(spark, "trips", landing, sink, ckpt)
    want = sorted(map(tuple, clean_trips(raw(spark, "trips", TRIPS)).collect()), key=str)
    assert sorted(map(tuple, out.collect()), key=str) == want
