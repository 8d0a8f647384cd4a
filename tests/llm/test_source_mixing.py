from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lakemart.llm import source_mixing as M
from lakemart.llm.queries import ORACLE_SQL
from lakemart.llm.source_mixing import SCHEDULES, integral, mix, op11_source_mixing, placements, share_targets, time_of, word_count
from lakemart.testing.compare import compare, duck_connect, duck_rows
from tests.llm.conftest import DOCS_SCHEMA, documents


def targets(sizes: dict) -> dict:
    """Water-filling in exact fractions, as the contract says it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out = {s: Fraction(0) for s in order}
    rest = Fraction(3 * sum(sizes.values()), 2)
    while rest > 0 and (free := [s for s in order if out[s] < 2 * sizes[s]]):
        share = rest / sum(weight[s] for s in free)
        rest = Fraction(0)
        for s in free:
            out[s] += share * weight[s]
            if out[s] > 2 * sizes[s]:
                rest += out[s] - 2 * sizes[s]
                out[s] = Fraction(2 * sizes[s])
    return out


def check(df, rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    sizes = defaultdict(int)
    for r, n in zip(rows, size):
        sizes[r[3]] += n
    want = targets(sizes)
    got = placements(df, columns=["doc_id", "text", "source"]).collect()
    assert sorted((str(g["doc_id"]), g["size"]) for g in got) == sorted((str(r[0]), n) for r, n in zip(rows, size))
    taken, longest = defaultdict(int), defaultdict(int)
    for g in got:
        s = None if g["s"] == "1" else g["s"][1:]
        assert g["source_size"] == sizes[s]
        assert g["target"] == pytest.approx(float(want[s]), rel=1e-12)
        assert g["taken"] == g["passes"] * g["size"] and g["passes"] <= 2 and len(g["positions"]) == g["passes"]
        assert all(0 <= p <= 1 for p in g["positions"]) and g["positions"] == sorted(g["positions"])
        taken[s] += g["taken"]
        longest[s] = max(longest[s], g["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= Fraction(longest[s], 2)
    return got


def test_odd_rows(spark, odd_docs, odd_rows):
    check(odd_docs, odd_rows)


def test_empty(spark, no_docs):
    assert op11_source_mixing(no_docs).collect() == []
    assert mix(no_docs).collect() == []


def test_rows_without_words(spark):
    rows = [(1, None, None, "a", 1), (2, " ", None, None, 1)]
    check(spark.createDataFrame(rows, DOCS_SCHEMA), rows)


def test_whole_table_against_sql(spark, sf001):
    df = op11_source_mixing(documents(spark, sf001))
    cols, rows = duck_rows(duck_connect(sf001), ORACLE_SQL["op11_source_mixing"])
    assert not compare(df.columns, [tuple(r) for r in df.collect()], cols, rows)


def test_hot_source_and_equal_rows(spark, monkeypatch):
    """A source of half the rows is several leaves; equal rows are told apart in blocks."""
    monkeypatch.setattr(M, "LEAF_ROWS", 16)
    monkeypatch.setattr(M, "COPIES_BLOCK", 7)
    draw = random.Random(3)
    rows = [(i, "w " * draw.randint(0, 30), "en", "hot" if i % 2 else f"s{i % 14}", 1) for i in range(600)]
    rows += [(900, "the same row", "en", "s2", 1)] * 50 + [(None, "b c d", None, None, None)] * 30
    a = check(spark.createDataFrame(rows, DOCS_SCHEMA), rows)
    b = check(spark.createDataFrame(rows[::-1], DOCS_SCHEMA).repartition(9), rows)
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_targets_are_capped_and_reshared(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, "d": 500, "e": 1, "f": 0}
    df = spark.createDataFrame([("0" + s, n) for s, n in sizes.items()], "s string, source_size long")
    got = {r["s"][1:]: r["target"] for r in share_targets(df).collect()}
    assert got == pytest.approx({s: float(v) for s, v in targets(sizes).items()})
    assert got["a"] == 20 and sum(got.values()) == pytest.approx(1.5 * 1514)


def test_schedules_are_inverted(spark):
    assert [integral(s) for s in SCHEDULES] == [5.0, 2.0, 1.0]
    odd = ((0.0, 0.0), (0.25, 0.0), (0.5, 4.0), (1.0, 0.0))
    for schedule in (*SCHEDULES, odd):
        shares = [i / 50 for i in range(51)]
        df = spark.createDataFrame([(y,) for y in shares], "y double").select("y", time_of(schedule, F.col("y")).alias("t"))
        for y, t in df.collect():
            upto = 0.0
            for (t1, w1), (t2, w2) in zip(schedule, schedule[1:]):
                end = min(max(t, t1), t2)
                w = w1 + (w2 - w1) * (end - t1) / (t2 - t1)
                upto += (end - t1) * (w1 + w) / 2
            assert math.isclose(upto, y * integral(schedule), abs_tol=1e-9)


def test_stream_follows_the_schedules(spark, sf001):
    docs = documents(spark, sf001).withColumn("extra", F.lit("kept"))
    places = placements(docs, columns=docs.columns)
    stream = mix(docs)
    assert stream.columns == [*docs.columns, "mix_position"]
    got = stream.select("doc_id", "mix_position", "extra").collect()
    want = places.select("doc_id", F.explode("positions").alias("p")).collect()
    assert sorted((r[0], r[1]) for r in got) == sorted(map(tuple, want))
    at = [r["mix_position"] for r in got]
    assert at == sorted(at) and got[0]["extra"] == "kept"
    # the falling schedule gives more words in the first half than in the second
    first = sorted({r["source"] for r in docs.select("source").distinct().collect()})[0]
    early = stream.where((F.col("source") == first) & (F.col("mix_position") < 0.5)).agg(F.sum(word_count(F.col("text")))).first()[0]
    late = stream.where((F.col("source") == first) & (F.col("mix_position") >= 0.5)).agg(F.sum(word_count(F.col("text")))).first()[0]
    assert early > late


def test_word_count_of_long_white_space(spark):
    texts = [" " * 3_000_000 + "a", "\t\n a\x0b\x0cb\rc ", "", None, "  ", " ", "x" * 1_000_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t")))
    assert [r[0] for r in df.collect()] == [1, 3, 0, 0, 0, 1, 1]


def test_no_python_on_the_main_path(spark, sf001):
    plan = op11_source_mixing(documents(spark, sf001))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
