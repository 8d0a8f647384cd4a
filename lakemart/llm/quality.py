"""Quality by ordinal cumulative-link regression on graded ratings.

Grades 0 < 1 < ... < K - 1 share one weight vector over hashed text features;
P(grade >= k) = sigmoid(w.x - t_k) with thresholds t_1 <= t_2 <= ... A text gets
its expected grade and the tail probability of the grade to select for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import pick, slices, prepare, to_batch

BUCKETS = 1 << 18
_LETTERS = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))


@dataclass(frozen=True)
class Params:
    """``sample_rows`` bounds the rated texts that the fit sees."""

    grades: int = 3
    sample_rows: int = 8000
    l1: float = 2e-4
    steps: int = 300
    select_at: float = 0.5


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # (BUCKETS,)
    thresholds: np.ndarray  # grades - 1, not falling


def _bucket(kind: str, what: object) -> int:
    return zlib.crc32(f"{kind}\x1f{what}".encode("utf-8", "replace")) % BUCKETS


def features(text: bytes) -> np.ndarray:
    """Distinct hashed features of a whole text: its lower-cased words (letters
    only), the shapes of the marks around them, and coarse shares: repeated
    neighbours, distinct words, capitals, marks, words by line."""
    words = text.split()
    lower = text.lower().split()
    n = len(words)
    if not n:
        return np.array([_bucket("empty", "")])
    distinct = set(lower)
    crc = zlib.crc32
    found = {crc(core, 1) % BUCKETS for w in distinct if (core := w.strip(_MARKS))}
    marked = {w.translate(_LETTERS, _KEEP_MARKS) for w in distinct}
    found.update(crc(m, 2) % BUCKETS for m in marked if m)
    same = sum(map(bytes.__eq__, lower[1:], lower))
    capitals = sum(map(bytes.isupper, words))
    marks = len(text.translate(None, _LETTER_BYTES)) - text.count(b" ") - text.count(b"\n")
    shares = {
        "repeat": same / n,
        "distinct": len(distinct) / n**0.85,
        "capitals": capitals / n,
        "marks": marks / len(text),
        "lines": text.count(b"\n") / n,
    }
    found.update(_bucket(k, min(int(10 * v), 12)) for k, v in shares.items())
    found.add(_bucket("length", int(np.log2(n))))
    return np.fromiter(found, np.int64, len(found))


_MARKS = bytes(c for c in range(128) if not chr(c).isalnum())
_KEEP_MARKS = bytes(c for c in range(256) if c >= 128 or chr(c).isalnum())
_LETTER_BYTES = _KEEP_MARKS


def _fit(rows: list[np.ndarray], grade: np.ndarray, p: Params) -> Model:
    """Proximal gradient steps (L1, accelerated) on the likelihood."""
    flat, size = np.concatenate(rows), np.array([len(r) for r in rows])
    used, flat = np.unique(flat, return_inverse=True)
    of, starts = np.repeat(np.arange(len(rows)), size), np.cumsum(size) - size
    n, ks = len(rows), np.arange(1, p.grades)
    share = np.array([np.clip((grade >= k).mean(), 1e-3, 1 - 1e-3) for k in ks])
    t = np.log((1 - share) / share)
    w, w_old, t_old, momentum = np.zeros(len(used)), np.zeros(len(used)), t.copy(), 1.0
    # a bucket steps by its frequency, so that rare telling words move as fast as common ones
    step = 4.0 / np.maximum(np.bincount(flat, minlength=len(used)) / n, 20.0 / n) / max(np.mean(size) ** 0.5, 1.0)
    for _ in range(p.steps):
        nxt = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        push = min((momentum - 1) / nxt, 0.9)
        wv, tv, momentum = w + push * (w - w_old), np.maximum.accumulate(t + push * (t - t_old)), nxt
        s = np.add.reduceat(wv[flat], starts)
        tail = 1 / (1 + np.exp(-np.clip(s[:, None] - tv, -30, 30)))  # P(grade >= k)
        full = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
        own = np.maximum(full[np.arange(n), grade] - full[np.arange(n), grade + 1], 1e-9)
        slope = full * (1 - full)
        up, down = slope[np.arange(n), grade] / own, slope[np.arange(n), grade + 1] / own
        g = -(up - down) / n
        gt = np.array([(np.where(grade == k, up, 0) - np.where(grade == k - 1, down, 0)).sum() for k in ks]) / n
        w_old, t_old = w, t
        w = wv - 0.5 * step * np.bincount(flat, weights=g[of], minlength=len(used))
        w = np.sign(w) * np.maximum(np.abs(w) - 0.5 * step * p.l1, 0)
        t = np.maximum.accumulate(tv - 0.5 * gt)
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return Model(weights, t)


def fit(rated: DataFrame, p: Params = Params()) -> Model:
    """Fit on columns (text, grade); rows with a null in either are left out.

    At most about ``sample_rows`` rows, chosen by a hash of the text (copies once), become
    feature lists in parallel; one task fits the bounded sample, and the model
    (a fixed number of weights) comes to the driver. Without rows every text
    gets the middle of the scale."""
    spark = rated.sparkSession
    prepare(spark)
    rated = rated.where(F.col("text").isNotNull() & F.col("grade").between(0, p.grades - 1))
    n = rated.count()
    if not n:
        return Model(np.zeros(BUCKETS), np.zeros(p.grades - 1))
    place = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1_000_000)) / F.lit(1e6)
    sample = rated.where(place < min(1.0, p.sample_rows / n)).select("text", F.col("grade").cast("int").alias("grade")).distinct()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches):
            yield to_batch(x=pa.array([features(t) for t in column.to_pylist()], pa.list_(pa.int64())), grade=batch.column(1))

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[: 2 * p.sample_rows]
        rows = rows.assign(key=[tuple(np.sort(x)) for x in rows["x"]]).sort_values(["grade", "key"])
        m = _fit([np.asarray(x) for x in rows["key"]], rows["grade"].to_numpy(np.int64), p)
        return pd.DataFrame({"weights": [m.weights.tobytes()], "thresholds": [m.thresholds.tobytes()]})

    features_of = sample.mapInArrow(listed, "x array<bigint>, grade int")
    model = features_of.groupBy(F.lit("all").alias("all")).applyInPandas(solve, "weights binary, thresholds binary").first()
    return Model(np.frombuffer(model["weights"]), np.frombuffer(model["thresholds"])) if model else Model(np.zeros(BUCKETS), np.zeros(p.grades - 1))


def tails(column: pa.Array, model: Model) -> np.ndarray:
    """P(grade >= k) for k = 1.. of each text of a large-binary array."""
    s = np.array([model.weights[features(t)].sum() for t in column.to_pylist()])
    return 1 / (1 + np.exp(-np.clip(s[:, None] - model.thresholds, -30, 30)))


def score_quality(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", p: Params = Params()) -> DataFrame:
    """doc_id, expected_grade, tails (P(grade >= k), k = 1..), selected (the last
    tail reaches ``select_at``) of every row, from its whole text.

    A null text is empty and is scored as such; repeated rows each get their
    row; a null id is passed through. Map-side only."""
    prepare(docs.sparkSession)
    source = pick(docs, doc_id=doc_id, text=text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches):
            tail = tails(column, shared.value)
            yield to_batch(
                doc_id=batch.column(0), expected_grade=tail.sum(axis=1),
                tails=pa.array(list(tail), pa.list_(pa.float64())), selected=tail[:, -1] >= p.select_at,
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, expected_grade double, tails array<double>, selected boolean")


def keep_selected(docs: DataFrame, model: Model, text: str = "text", p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are selected."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches, text):
            yield batch.filter(pa.array(tails(column, shared.value)[:, -1] >= p.select_at))

    return docs.mapInArrow(run, docs.schema)


def grade(quality: Column, toxic: Column) -> Column:
    """The rating scale: 0 toxic, 1 of low quality, 2 good; null without a full label."""
    return F.when(toxic.isNull() | quality.isNull(), None).when(toxic != 0, 0).when(quality == 0, 1).otherwise(2)


def rated_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, grade) of the documents that have a label."""
    rating = labels.select(F.col("doc_id").alias("_llm_id"), grade(F.col("quality"), F.col("toxic")).alias("grade"))
    rating = rating.where("grade is not null")
    return docs.select("doc_id", "text").join(rating, F.col("doc_id") == F.col("_llm_id")).select("text", "grade")


def op4_quality(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    found = score_quality(docs, fit(rated_documents(docs, labels), p), p=p)
    return found.select(
        "doc_id", "expected_grade", F.col("tails")[0].alias("p_not_toxic"), F.col("tails")[1].alias("p_good"), "selected"
    )
