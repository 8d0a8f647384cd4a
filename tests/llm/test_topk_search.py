import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from lakemart.llm import topk_search as K


def brute(rows, every=100, k=10):
    """Every row but the query's own is a candidate; ties to the smaller id, no id last."""
    ok = [(i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, qv) in enumerate(ok):
        if q is not None and q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v)), i is None, i or 0) for m, (i, v) in enumerate(ok) if m != n and len(v) == len(qv))
            out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(scored[:k])]
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0, r[3]))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_equals_brute_force_with_ties_nulls_and_repeats(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.25, 1.5]) for _ in range(6)]) for i in range(1500)]
    rows += [(2000 + i, rows[5][1]) for i in range(300)] + rows[:20]
    rows += [(700, [9.0] * 6), (700, [-9.0] * 6)] + [(None, [8.0, -8.0, 8.0, -8.0, 8.0, 8.0])] * 2
    rows += [(None, [1.0] * 6), (5000, None), (5100, [None] + [1.0] * 5), (5200, [float("nan")] * 6), (5300, [float("inf")] * 6), (5400, []), (5500, [1.0, 2.0]), (5501, [2.0, 1.0]), (5600, [0.0] * 6)]
    df = frame(spark, rows).withColumn("v", F.lit(1)).withColumn("dims", F.lit(2)).withColumn("shard", F.lit(3))
    want = brute(rows)
    assert in_order(K.op9_topk_search(df).collect()) == in_order(want)
    monkeypatch.setattr(K, "SHARD_ROWS", 150)
    monkeypatch.setattr(K, "QUERY_BLOCK", 4)
    monkeypatch.setattr(K, "SHARDS", 1)
    assert in_order(K.op9_topk_search(df).collect()) == in_order(want)


def test_large_values_stay_exact(spark):
    """Scores past what a double holds exactly, but within a long."""
    rows = [(i, [1.0e6 + i, -1.0e6]) for i in range(0, 400, 50)]
    assert sorted(map(tuple, K.op9_topk_search(frame(spark, rows)).collect())) == sorted(brute([(i, v) for i, v in rows]))


def test_stops_early_where_the_bound_allows():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 50, (4000, 3))
    x[:20] += 1000
    lists = K.SortedLists(np.arange(4000), np.arange(4000), np.zeros(4000, bool), x)
    ids, scores = lists.top(-1, np.array([1, 2, 3]), 10)
    best = sorted((-int(v @ [1, 2, 3]), i) for i, v in enumerate(x))[:10]
    assert list(zip(-scores, ids)) == best


def test_repeated_rows_shared_ids_and_no_id(spark):
    """As the contract says: a query misses its own row only."""
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.2, 0.0]), (None, [1.0, 0.0]), (0, [1.0, 0.0])]
    got = in_order(K.op9_topk_search(frame(spark, rows)).collect())
    assert got == in_order(brute(rows))
    # each of the two equal rows finds the other, both rows of id 1, the row without id, then the rest
    assert [r[2] for r in got].count(None) == 3 and len(got) == 3 * 6


def test_sql_keeps_repeats_too(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.2, 0.0]), (None, [1.0, 0.0]), (3, None), (4, [None, 1.0])]
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/e")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/e/*.parquet')")
    assert in_order(con.execute(K.ORACLE_SQL).fetchall()) == in_order(brute(rows))


def test_rows_are_copied_by_blocks_not_by_queries():
    """Copies of a row over the query blocks, and of a query over the shards, at 100 million rows."""
    n = 100_000_000
    assert math.ceil(n / 100 / K.QUERY_BLOCK) <= 16 and math.ceil(n / K.SHARD_ROWS) <= 1600


def test_equals_sql_and_empty_table(spark, sf001):
    df = spark.read.parquet(f"{sf001}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf001}/embeddings.parquet')")
    assert sorted(map(tuple, K.op9_topk_search(df).collect())) == sorted(con.execute(K.ORACLE_SQL).fetchall())
    assert K.op9_topk_search(df.limit(0)).count() == 0
