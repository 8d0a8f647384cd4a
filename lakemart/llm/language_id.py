"""Language identification by nearest centroid.

Texts become hashed byte n-gram counts (n = 1 to 3, ASCII lower-cased, other
ASCII than letters as a space), weighted by TF-IDF and normalised. Each
language has a few centroids, found by spherical k-means over a bounded sample
of its labelled texts; a text gets the language of the centroid with the
largest cosine and is rejected if that cosine is under the language's
threshold (a low quantile of its sample's own cosines, with slack).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import buffers, fold, pick, slices, prepare, to_batch
from lakemart.llm.words import LOWER

DIMS = 4096
UNDETERMINED = "und"

_CHAR = LOWER.copy()
_CHAR[:128][~((LOWER[:128] >= 97) & (LOWER[:128] <= 122))] = 32


@dataclass(frozen=True)
class Params:
    """``sample_per_language`` bounds the labelled texts that the fit sees;
    ``max_languages`` bounds what the model can hold."""

    sample_per_language: int = 500
    max_languages: int = 500
    clusters: int = 4
    iterations: int = 8
    reject_quantile: float = 0.005
    reject_slack: float = 0.5


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray  # (languages * clusters, DIMS), rows of norm 1 or 0
    owner: np.ndarray  # language of each centroid
    threshold: np.ndarray  # least cosine by language


def term_counts(column: pa.Array) -> np.ndarray:
    """Hashed n-gram counts of each text of a large-binary array, by row."""
    raw, offsets = buffers(column)
    c = _CHAR[raw].astype(np.uint32)
    two = (c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA6B)) if len(c) > 1 else c[:0]
    three = two[:-1] * np.uint32(0x27D4EB2F) + c[2:] * np.uint32(0xC2B2AE35) if len(c) > 2 else c[:0]
    grams = [(c & 255).astype(np.int32), 256 + (two >> np.uint32(22)).astype(np.int32) % 768, 1024 + (three >> np.uint32(16)).astype(np.int32) % 3072]
    out = np.zeros((len(column), DIMS), np.float32)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        for n, g in enumerate(grams):
            if b - n > a:
                out[i] += np.bincount(g[a : b - n], minlength=DIMS)
    return out


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _spherical_kmeans(x: np.ndarray, k: int, iterations: int) -> np.ndarray:
    """Centroids started by farthest-first from the mean, so that a run repeats."""
    mean = x.mean(axis=0)
    centres = [x[np.argmax(x @ mean)]]
    while len(centres) < min(k, len(x)):
        centres.append(x[np.argmin(np.max(x @ np.array(centres).T, axis=1))])
    c = np.array(centres)
    for _ in range(iterations):
        own = np.argmax(x @ c.T, axis=1)
        c = np.array([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(labelled: DataFrame, p: Params = Params()) -> Model:
    """Fit on columns (id, text, lang); rows with a null text or lang are left out.

    Two Spark jobs over a sample of about ``sample_per_language`` texts of each
    language, chosen by a hash of id and text (copies once): document frequencies,
    then k-means by language over the texts' n-gram counts (a fixed size, however
    long the text). Only the model (at most ``max_languages`` x ``clusters`` vectors)
    reaches the driver. No labelled rows give a model without languages."""
    prepare(labelled.sparkSession)
    labelled = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = labelled.groupBy("lang").count().orderBy("lang").limit(p.max_languages + 1).collect()
    if len(sizes) > p.max_languages:
        raise ValueError(f"over {p.max_languages} languages; raise max_languages")
    if not sizes:
        return Model((), np.ones(DIMS, np.float32), np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros(0))
    rate = F.lit(None).cast("double")
    for r in sizes:
        rate = F.when(F.col("lang") == r["lang"], F.lit(p.sample_per_language / r["count"])).otherwise(rate)
    place = F.pmod(F.xxhash64("id", "text", F.lit(7)), F.lit(1_000_000)) / F.lit(1e6)
    sample = labelled.where(place < rate).select("lang", "text").distinct()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(DIMS, np.int64), 0
        for batch, column in slices(batches):
            total += (term_counts(column) > 0).sum(axis=0)
            rows += len(column)
        yield to_batch(dim=np.arange(DIMS + 1, dtype=np.int32), n=np.append(total, rows))

    found = sample.mapInArrow(frequencies, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(DIMS + 1)
    for r in found:
        n[r["dim"]] = r["n"]
    idf = np.log((1 + n[-1]) / (1 + n[:-1])).astype(np.float32) + np.float32(0.05)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches):
            yield to_batch(lang=batch.column(0), x=pa.array([v.tobytes() for v in term_counts(column)], pa.binary()))

    def clusters(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = unit_vectors(np.stack([np.frombuffer(v, np.float32) for v in sorted(rows["x"])]), idf)
        c = _spherical_kmeans(x, p.clusters, p.iterations)
        least = np.quantile(np.max(x @ c.T, axis=1), p.reject_quantile) * p.reject_slack
        return pd.DataFrame({"lang": key[0], "least": least, "vector": [v.astype("<f4").tobytes() for v in c]})

    counts = sample.mapInArrow(counted, "lang string, x binary")
    rows = counts.groupBy("lang").applyInPandas(clusters, "lang string, least double, vector binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["vector"])))
    languages = tuple(dict.fromkeys(r["lang"] for r in rows))
    least = {r["lang"]: r["least"] for r in rows}
    return Model(
        languages,
        idf,
        np.array([np.frombuffer(r["vector"], "<f4") for r in rows]),
        np.array([languages.index(r["lang"]) for r in rows]),
        np.array([least[x] for x in languages]),
    )


def classify(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, cosine (0 to 1) and whether the distance rule rejects, by text."""
    texts = [t.decode("utf-8", "replace") for t in column.to_pylist()]
    letters = np.array([any(map(str.isalpha, t)) for t in texts], bool)
    n = len(texts)
    if not model.languages or not n:
        return [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
    cosine = unit_vectors(term_counts(column), model.idf) @ model.centroids.T
    best = np.argmax(cosine, axis=1)
    owner = model.owner[best]
    score = np.where(letters, np.clip(cosine[np.arange(n), best].astype(float), 0.0, 1.0), 0.0)
    rejected = ~letters | (score < model.threshold[owner])
    return [model.languages[o] if ok else UNDETERMINED for o, ok in zip(owner, letters, strict=True)], score, rejected


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row, from its whole text.

    A null text, or one without any letter, is ``und`` with score 0, rejected.
    Rows with equal texts get equal results; a null id is passed through; ties
    between centroids go to the first language by name. Map-side only."""
    prepare(docs.sparkSession)
    source = pick(docs, doc_id=doc_id, text=text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches):
            lang, score, rejected = classify(column, shared.value)
            yield to_batch(doc_id=batch.column(0), lang_pred=pa.array(lang, pa.string()), score=score, rejected=rejected)

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model does not reject."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches, text):
            yield batch.filter(pa.array(~classify(column, shared.value)[2]))

    return docs.mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """(id, text, lang) of the documents outside the held-out fold (crc32 mod 5 = 0)."""
    return docs.where(fold(F.col("doc_id")) != 0).select(F.col("doc_id").alias("id"), "text", "lang")


def op1_language_id(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The contract's rows: doc_id, held_out, lang_pred, score, and rejected."""
    found = identify(docs, fit(training_rows(docs), p))
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "rejected")
