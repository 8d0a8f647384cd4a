import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from lakemart.llm import quality as Q

from .conftest import documents


def test_held_out_grades(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    model = Q.fit(Q.rated_documents(docs, labels.where("doc_id % 4 <> 0")))
    held = docs.join(labels.where("doc_id % 4 = 0").select("doc_id", Q.grade(F.col("quality"), F.col("toxic")).alias("g")), "doc_id")
    found = {r["doc_id"]: r for r in Q.score_quality(held, model).collect()}
    grades = {r["doc_id"]: r["g"] for r in held.select("doc_id", "g").collect()}
    share = lambda g: np.mean([found[d]["selected"] for d in grades if grades[d] == g])
    assert share(2) > 0.98 and share(1) < 0.05 and share(0) < 0.08
    mean = lambda g: np.mean([found[d]["expected_grade"] for d in grades if grades[d] == g])
    assert mean(0) < mean(1) < mean(2)
    for r in found.values():
        assert list(r["tails"]) == sorted(r["tails"], reverse=True)
        assert abs(r["expected_grade"] - sum(r["tails"])) < 1e-9


def test_odd_rows_and_empty_tables(spark, odd_docs, odd_rows, no_docs, sf001):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (5, 0, 0), (8, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = Q.op4_quality(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r["expected_grade"] <= 2 for r in rows)
    assert Q.op4_quality(no_docs, labels).count() == 0
    untaught = Q.op4_quality(odd_docs, labels.limit(0)).collect()
    assert {r["expected_grade"] for r in untaught} == {1.0}
    kept = Q.keep_selected(odd_docs, Q.fit(Q.rated_documents(odd_docs, labels)))
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r["selected"] for r in rows)


def test_thresholds_do_not_cross():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 50, 12)) for _ in range(300)]
    grade = np.array([0 if 1 in r else 2 if 2 in r else 1 for r in rows])
    m = Q._fit(rows, grade, Q.Params())
    assert m.thresholds[0] <= m.thresholds[1]
    assert m.weights[2] > 0 > m.weights[1]


def plain_features(text):
    """The hashed features of a text, by string operations on Latin-1 characters (a byte each)."""
    t = text.encode().decode("latin-1")
    spaces = " \t\n\x0b\x0c\r"
    words = [w for w in "".join(" " if c in spaces else c for c in t).split(" ") if w]
    low = lambda w: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
    alnum = lambda c: ord(c) >= 128 or c.isascii() and c.isalnum()
    bucket = lambda data, seed: zlib.crc32(data.encode("latin-1"), seed) % Q.BUCKETS
    named = lambda kind, what: zlib.crc32(f"{kind}\x1f{what}".encode()) % Q.BUCKETS
    if not words:
        return {named("empty", "")}
    n, lower, out = len(words), [low(w) for w in words], set()
    for w in set(lower):
        core = w
        while core and not alnum(core[0]):
            core = core[1:]
        while core and not alnum(core[-1]):
            core = core[:-1]
        if core:
            out.add(bucket(core, 1))
        marks = "".join(c for c in w if not alnum(c))
        if marks:
            out.add(bucket(marks, 2))
    capital = lambda w: any("A" <= c <= "Z" for c in w) and not any("a" <= c <= "z" for c in w)
    shares = {
        "repeat": sum(a == b for a, b in zip(lower, lower[1:])) / n,
        "distinct": len(set(lower)) / n**0.85,
        "capitals": sum(map(capital, words)) / n,
        "marks": sum(not alnum(c) and c not in " \n" for c in t) / len(t),
        "lines": t.count("\n") / n,
    }
    out |= {named(k, min(int(10 * v), 12)) for k, v in shares.items()}
    return out | {named("length", int(math.log2(n)))}


def test_tails_equal_plain_python(spark, sf001):
    docs, labels = documents(spark, sf001), spark.read.parquet(f"{sf001}/labels.parquet")
    model = Q.fit(Q.rated_documents(docs, labels))
    got = {r["doc_id"]: r for r in Q.score_quality(docs, model).collect()}
    for r in docs.select("doc_id", "text").collect():
        s = sum(model.weights[f] for f in plain_features(r["text"] or ""))
        tails = [1 / (1 + math.exp(-max(-30, min(30, s - t)))) for t in model.thresholds]
        g = got[r["doc_id"]]
        assert max(abs(a - b) for a, b in zip(tails, g["tails"])) < 1e-9
        assert abs(g["expected_grade"] - sum(tails)) < 1e-9 and g["selected"] == (tails[-1] >= 0.5)


def objective(w, t, rows, grade, l1):
    """Mean negative log-likelihood of the cumulative-link model, and the L1 penalty, in plain loops."""
    total = 0.0
    for r, g in zip(rows, grade):
        s = sum(w[i] for i in r)
        tail = [1.0, *[1 / (1 + math.exp(-(s - x))) for x in t], 0.0]
        total -= math.log(max(tail[g] - tail[g + 1], 1e-9))
    return total / len(rows) + l1 * sum(map(abs, w))


def test_fit_is_at_the_minimum_of_the_likelihood():
    """No other weights or thresholds nearby, nor those of a plain coordinate search, do better."""
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 6, 3)) for _ in range(150)]
    score = np.array([sum({0: 2.0, 1: -2.0, 2: 0.7}.get(int(i), 0.0) for i in r) for r in rows]) + rng.logistic(size=150)
    grade = np.digitize(score, [-0.8, 0.9])
    p = Q.Params()
    m = Q._fit(rows, grade, p)
    x = [*m.weights[:6], *m.thresholds]
    value = lambda v: objective(v[:6], v[6:], rows, grade, p.l1)
    best = value(x)
    plain, step = [0.0] * 6 + [-0.5, 0.5], 0.5
    while step > 1e-3:  # plain coordinate search from nothing
        moved = False
        for k in range(8):
            for d in (step, -step):
                trial = [*plain]
                trial[k] += d
                if trial[6] <= trial[7] and value(trial) < value(plain) - 1e-12:
                    plain, moved = trial, True
        step = step if moved else step / 2
    assert best <= value(plain) + 2e-3
    for k in range(8):
        for d in (0.05, -0.05):
            trial = [*x]
            trial[k] += d
            assert value(trial) > best - 1e-3
