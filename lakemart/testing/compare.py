"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 9)
    if isinstance(v, Decimal):
        return v.normalize() if v == v else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", str(x)) for x in row)


def compare(spark_cols, spark_rows, duck_cols, duck_rows_):
    """Return a list of problems (empty when equal as multisets of rows)."""
    problems = []
    if sorted(spark_cols) != sorted(duck_cols):
        problems.append(f"columns differ: spark={spark_cols} duck={duck_cols}")
        return problems
    order = sorted(range(len(spark_cols)), key=lambda i: spark_cols[i])
    dorder = [duck_cols.index(spark_cols[i]) for i in order]
    s = sorted((tuple(_norm(r[i]) for i in order) for r in spark_rows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in dorder) for r in duck_rows_), key=_key)
    if len(s) != len(d):
        problems.append(f"row count differs: spark={len(s)} duck={len(d)}")
    bad = 0
    for a, b in zip(s, d):
        if a != b:
            bad += 1
            if bad <= 5:
                problems.append(f"row differs: spark={a} duck={b}")
    if bad:
        problems.append(f"{bad} differing rows")
    return problems
