"""Connected components of a graph of links, by large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import cut, discard

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (columns a, b; a != b): the
    smallest node reachable.

    Each round links every node's larger neighbours, then its smaller ones, to
    the smallest neighbour; the rounds grow with the logarithm of the longest
    path. A node's smallest neighbour is a map-side combined aggregate joined
    back to the links, so a hub is never collected; each round is written to the
    shared folder, and dropped when the next one is."""
    edges = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(edges)
    for _ in range(MOST_ROUNDS):
        large = _large_star(edges)
        discard(edges)
        edges = _small_star(large)
        discard(large)
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError("the links did not settle")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written, so that the join below has a plain shuffle on each side and a hub's rows can be split
    least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    larger = edges.select(F.col("a").alias("x"), F.col("b").alias("a"))
    out = cut(larger.join(least, "a").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
    discard(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    least = cut(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    swapped = linked.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    out = cut(swapped.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    discard(least)
    return out
