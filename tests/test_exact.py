"""Exact HALF_UP rounding helpers against Python integer arithmetic."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from lakemart.functions import half_up_div, half_up_div_long, minutes_rounded, money_mean


def _ref(n, d):
    q = (2 * abs(n) + d) // (2 * d)
    return -q if n < 0 else q


def test_half_up_div_long_and_decimal(spark):
    rnd = random.Random(7)
    pairs = [(5, 10), (-5, 10), (15, 10), (-15, 10), (0, 3), (1, 2), (-1, 2), (7, 0)]
    for _ in range(3000):
        mag = rnd.choice([10, 10**4, 10**9, 10**15, 4 * 10**18])
        pairs.append((rnd.randint(-mag, mag) // 2, rnd.choice([1, 60, 120, 7, 3 * 10**14, rnd.randint(1, 10**9)])))
    df = spark.createDataFrame(pairs, "n long, d long")
    out = df.select("n", "d", half_up_div_long(F.col("n"), F.col("d")).alias("a"),
                    half_up_div(F.col("n"), F.col("d")).cast("long").alias("b")).collect()
    for r in out:
        want = None if r.d == 0 else _ref(r.n, r.d)
        assert (r.a, r.b) == (want, want), r


def test_minutes_rounded_exact_on_ties(spark):
    # 10 rides, 3 seconds in all: 0.005 minutes on average -> 0.01 (HALF_UP)
    df = spark.createDataFrame([(3, 10), (-3, 10), (90, 1), (1, 3)], "s long, n long")
    got = [r[0] for r in df.select(minutes_rounded("s", "n")).collect()]
    assert got == [0.01, -0.01, 1.5, 0.01]


def test_money_mean_matches_decimal_avg_then_round(spark):
    rnd = random.Random(3)
    groups = [[Decimal(rnd.randint(0, 99999)) / 100 for _ in range(rnd.randint(1, 9))] for _ in range(300)]
    groups.append([Decimal("0.01"), Decimal("0.02")])
    rows = [(i, a) for i, g in enumerate(groups) for a in g]
    df = spark.createDataFrame(rows, "g int, a decimal(10,2)")
    ours = {r.g: r.m for r in df.groupBy("g").agg(money_mean(F.sum("a"), F.count("a")).alias("m")).collect()}
    spark_avg = {r.g: r.m for r in df.groupBy("g").agg(F.round(F.avg("a"), 2).alias("m")).collect()}
    for i, g in enumerate(groups):
        exact6 = (sum(g) / len(g)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        assert ours[i] == exact6.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert ours[i] == spark_avg[i]  # same as Spark's own decimal avg + round
