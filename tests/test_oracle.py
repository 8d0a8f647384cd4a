"""Every registered product against its DuckDB SQL on the smallest test tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from lakemart.plans.registry import QUERIES
from lakemart.testing.compare import compare, duck_connect, duck_rows
from lakemart.testing.oracle import ORACLE_SQL as ORACLE


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    dcols, drows = duck_rows(duck, ORACLE[name])
    assert compare(df.columns, rows, dcols, drows) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "day_of_week", "ride_count", "avg_trip_minutes", "total_trip_minutes"]
    assert df.count() > 0
