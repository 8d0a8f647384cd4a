from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from lakemart.llm import fill_in_middle as M
from lakemart.llm.common import buffers
from lakemart.llm.fill_in_middle import fill_in_middle, grow, op12_fill_in_middle, restore, split
from lakemart.llm.queries import ORACLE_SQL
from lakemart.testing.compare import compare, duck_connect, duck_rows
from tests.llm.conftest import DOCS_SCHEMA, documents


def brute(doc_id, text):
    """The contract over Python strings."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        form, out = "plain", text
    elif h[3] % 100 < 20:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    sizes = (None, None) if form == "plain" else (len(prefix), len(middle))
    return (doc_id, n, form, *sizes, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def key(row):
    return tuple(str(v) for v in row)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_odd_rows(spark, odd_docs, odd_rows):
    assert rows_of(op12_fill_in_middle(odd_docs)) == sorted((brute(r[0], r[1]) for r in odd_rows), key=key)


def test_empty(spark, no_docs):
    assert op12_fill_in_middle(no_docs).collect() == []


def test_whole_table_against_sql(spark, sf001):
    df = op12_fill_in_middle(documents(spark, sf001))
    cols, rows = duck_rows(duck_connect(sf001), ORACLE_SQL["op12_fill_in_middle"])
    assert not compare(df.columns, [tuple(r) for r in df.collect()], cols, rows)


def test_marks_in_the_text(spark):
    texts = ["a<P>b", "<S>", "x<M", "<<P", "P><S", "<P<S<M", ">" * 50, "<" * 50, "<M" * 30 + "é"]
    rows = [(i * 10 + k, t, "en", "s", 1) for k, t in enumerate(texts) for i in range(40)]
    df = spark.createDataFrame(rows, DOCS_SCHEMA)
    assert rows_of(op12_fill_in_middle(df)) == sorted((brute(r[0], r[1]) for r in rows), key=key)


def texts_of_every_size():
    draw = random.Random(5)
    sizes = [0, 1, 2, 1023, 1024, 1025, 2048, 3000, 10_000, 70_000]
    return ["".join(draw.choice("aé日𝄞 \n\t") for _ in range(n)) for n in sizes] + ["é" * 5000, " " * 4096, "𝄞" * 1024]


def test_descent_finds_every_cut():
    texts = texts_of_every_size()
    raw, offsets = buffers(pa.array([t.encode() for t in texts], pa.large_binary()))
    forest = grow(raw, offsets)
    assert forest.totals[:, 0].tolist() == [len(t) for t in texts]
    draw = random.Random(1)
    for _ in range(60):
        k = np.array([draw.choice([0, len(t), draw.randint(0, len(t))]) for t in texts])
        place, points = forest.find(k)
        assert place.tolist() == [len(t[:i].encode()) for t, i in zip(texts, k)]
        assert points.tolist() == k.tolist()


@pytest.mark.parametrize("unit", ["word", "line"])
def test_other_units(unit):
    texts = texts_of_every_size() + ["  lead and trail  ", "one\ntwo\n\nfour", "\n", "word " * 3000]
    spaces = " \t\n\x0b\x0c\r"
    raw, offsets = buffers(pa.array([t.encode() for t in texts], pa.large_binary()))
    forest = grow(raw, offsets, unit)
    for t, text in enumerate(texts):
        if unit == "word":
            begins = [i for i, c in enumerate(text) if i == 0 or (c not in spaces and text[i - 1] in spaces)]
        else:
            begins = [i for i in range(len(text)) if i == 0 or text[i - 1] == "\n"]
        assert forest.totals[t].tolist() == [len(begins), len(text)]
        for k in {0, 1, len(begins) // 2, len(begins) - 1, len(begins)}:
            if 0 <= k <= len(begins):
                ask = np.zeros(len(texts), np.int64)
                ask[t] = k
                place, points = forest.find(ask)
                upto = begins[k] if k < len(begins) else len(text)
                assert (place[t], points[t]) == (len(text[:upto].encode()), upto)


def test_real_outputs(spark):
    rows = [(i, "Some words to be cut, 日本語 too", "en", "s", 1) for i in range(200)]
    out = fill_in_middle(spark.createDataFrame(rows, DOCS_SCHEMA), unit="word").collect()
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    for r in out:
        assert r["n"] == 7 and r["restored"] == rows[0][1]
        assert restore(r["form"], r["output"].encode()).decode() == rows[0][1]
    with pytest.raises(ValueError):
        split(np.zeros(1, np.uint8), np.array([0, 1]), np.array([0]), np.array([0]), "page")


def test_the_largest_slice_is_bounded():
    assert M.BLOCK * 4 <= 4096
