"""Exact top-k by inner product with Fagin's threshold algorithm.

Candidates are dealt into shards; within a shard every dimension has its rows
sorted by value. A query reads the lists of its dimensions side by side from
the favourable end, scores each row it meets for the first time, and stops when
the best score that an unmet row could have is below its k-th score. The shards'
results are merged by Spark.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import cut, pick, prepare

#: Candidates of one shard and queries of one block, at most: what a task holds at
#: once, and how often each row is copied (rows / 65,536 and queries / 65,536 times).
SHARD_ROWS = 65_536
QUERY_BLOCK = 65_536
#: A smaller table is still dealt into this many shards, if they get LEAST_ROWS each.
SHARDS, LEAST_ROWS = 64, 1024
SCALE = 1024
FIRST_DEPTH = 64
_EXACT = float(1 << 53)


class SortedLists:
    """A shard's rows with their order in each dimension. ``rows`` numbers them
    over the whole table; ``ids`` are their ids (``NO_ID`` for none), ``none``
    tells which have none."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, none: np.ndarray, vectors: np.ndarray):
        order = np.lexsort([none, ids])
        self.rows, self.ids, self.none, self.x = rows[order], ids[order], none[order], vectors[order]
        self.by_dim = np.argsort(self.x, axis=0, kind="stable").T.copy()  # rows of each dimension, rising
        self.most = float(np.abs(self.x.astype(np.float64)).max(initial=0.0))
        self.fx = self.x.astype(np.float64)

    def top(self, query_row: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (in ``ids`` and ``none``) and exact scores of the k best rows but the query's own."""
        n, dims = self.x.shape
        exact = self.most * float(np.abs(q.astype(np.float64)).max(initial=0.0)) * dims < _EXACT
        x, qv = (self.fx, q.astype(np.float64)) if exact else (self.x.astype(object), q.astype(object))
        live = np.flatnonzero(q)
        up = q[live] > 0
        seen = np.zeros(n, bool)
        best_rows, best_scores = np.zeros(0, np.int64), np.zeros(0, qv.dtype)
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            upto = min(n, depth + step) if len(live) else n
            lists = self.by_dim[live]
            met = np.concatenate([lists[up, n - upto : n - depth].ravel(), lists[~up, depth:upto].ravel()]) if len(live) else np.arange(n)
            mark = np.zeros(n, bool)
            mark[met] = True
            rows = np.flatnonzero(mark & ~seen)
            seen[rows] = True
            rows = rows[self.rows[rows] != query_row]
            best_rows = np.concatenate([best_rows, rows])
            best_scores = np.concatenate([best_scores, x[rows] @ qv])
            if len(best_rows) > k:
                at = np.lexsort([best_rows, -best_scores])[:k]  # places are in the order of ids
                best_rows, best_scores = best_rows[at], best_scores[at]
            depth, step = upto, step * 2
            if depth < n and len(best_rows) == k:
                edge = np.where(up, self.by_dim[live, n - depth], self.by_dim[live, depth - 1])
                if best_scores.min() > x[edge, live] @ qv[live]:
                    break
        return best_rows, np.array([_long(s) for s in best_scores], np.int64)


def _long(score: object) -> int:
    return max(min(int(score), (1 << 63) - 1), -(1 << 63))


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (array of floor(1024 * x) as longs) and its length, of the rows
    whose components are all there and finite. Repeated rows, and rows that share
    an id or have none, are rows of their own."""
    source = pick(vectors, vec_id=vec_id, e=embedding)
    wide = F.transform("e", lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = source.where(F.col("e").isNotNull() & (F.size("e") > 0) & finite)
    v = F.transform(wide, lambda x: F.floor(F.lit(float(SCALE)) * x)).alias("v")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v).select("*", F.size("v").alias("dims"))


#: Stands for no id where ids are compared; such rows come after the row with this id.
NO_ID = (1 << 63) - 1


def search(rows: DataFrame, asks: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``rows`` (as ``quantised``
    gives them) where ``asks`` holds, the k other rows with the highest inner
    product to it; ties to the smaller id, rows without an id last.

    Every row but the query's own is a candidate, so repeats of a row, and other
    rows of its id, find each other. Vectors only meet vectors of their own
    length. Scores beyond the range of a long are given as its end. Each row is
    dealt to a shard by its number, so equal vectors are spread.

    Queries meet all rows in blocks: a task holds one shard and one query block,
    and a shard's lists are sorted once a block."""
    prepare(rows.sparkSession)
    named = rows.select(
        F.coalesce("vec_id", F.lit(NO_ID)).alias("id"), F.col("vec_id").isNull().alias("none"), "v", "dims",
        F.coalesce(asks, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"),
    )
    held = cut(named, "vectors")  # numbered once
    n = held.agg(F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("asked")).first()
    shards = max(1, math.ceil(n["rows"] / SHARD_ROWS), min(SHARDS, math.ceil(n["rows"] / LEAST_ROWS)))
    query_blocks = max(1, math.ceil(n["asked"] / QUERY_BLOCK))
    each_block = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("block")
    each_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(query_blocks)).cast("int").alias("block")
    left = held.select("row", "id", "none", "v", "dims", shard, each_block)
    right = held.where("asks").select("row", "id", "v", "dims", each_shard, block)

    def run(part: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(part) and len(questions):
            columns = (part[c].to_numpy(t) for c, t in (("row", np.int64), ("id", np.int64), ("none", bool)))
            lists = SortedLists(*columns, np.stack(part["v"].to_list()))
            for row, query_id, q in zip(questions["row"], questions["id"], questions["v"], strict=True):
                at, scores = lists.top(row, np.asarray(q), k)
                out.append(pd.DataFrame({"query": row, "query_id": query_id, "id": lists.ids[at], "none": lists.none[at], "score": scores}))
        empty = pd.DataFrame({"query": [], "query_id": [], "id": [], "none": [], "score": []})
        return pd.concat(out) if out else empty.astype({c: bool if c == "none" else "int64" for c in empty})

    keys = ["dims", "shard", "block"]
    local = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "query long, query_id long, id long, none boolean, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "none")
    ranked = local.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.when(~F.col("none"), F.col("id")).alias("vec_id"), "score")


def op9_topk_search(embeddings: DataFrame) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 100, against all rows."""
    return search(quantised(embeddings), F.pmod("vec_id", F.lit(100)) == 0, 10)


ORACLE_SQL = """
WITH held AS (
  SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0),
wide AS (SELECT r, vec_id, len(e) AS dims, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM held),
odd AS (SELECT DISTINCT r FROM wide WHERE x IS NULL OR NOT isfinite(x)),
v AS (
  SELECT r, vec_id, dims, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM wide WHERE r NOT IN (SELECT r FROM odd)),
scored AS (
  SELECT a.r AS query, a.vec_id AS query_id, b.r, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.i = b.i AND a.dims = b.dims AND a.r <> b.r
  WHERE a.vec_id % 100 = 0
  GROUP BY 1, 2, 3, 4),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
