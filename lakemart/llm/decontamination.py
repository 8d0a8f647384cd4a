"""Benchmark decontamination by winnowing.

A window is 10 consecutive words (an item of fewer words is one window). Its
fingerprint is the least hash among the 5-word grams in it, so two equal
windows always have equal fingerprints: every shared span of a window's length
is found. Document fingerprints that may occur in the benchmark (tested against
a bit table of fixed size) are joined with the benchmark's fingerprints; each
match is extended to the whole window, word for word. Equality of the words
decides, never a hash alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import cut, pick, slices, prepare, to_batch
from lakemart.llm.words import ALNUM, Words, single_spaced, split_words, xxh64

WINDOW = 10
GRAM = 5
#: Bits of the table that screens document fingerprints: 4 MB, whatever the benchmark's size.
FILTER_BITS = 25
_MIX = np.uint64(0x9E3779B97F4A7C15)


def window_fingerprints(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and fingerprint of every window of ``length`` words that lies
    within one text: the least hash of its grams of min(GRAM, length) words."""
    gram = min(GRAM, length)
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        g = hashes[: len(hashes) - gram + 1] * _MIX
        for j in range(1, gram):
            g = (g + hashes[j : len(hashes) - gram + 1 + j]) * _MIX
        g ^= g >> np.uint64(29)
        g = g * np.uint64(2 * length + 1)
        g ^= g >> np.uint64(32)
    least = g[:n].copy()
    for j in range(1, length - gram + 1):
        np.minimum(least, g[j : n + j], out=least)
    counts = words.counts
    last = np.repeat(words.first[1:], counts)[:n]  # words of a window's text end here
    starts = np.flatnonzero(np.arange(n) + length <= last)
    return starts, least[starts]


def _hashes(words: Words) -> np.ndarray:
    return xxh64(words.data, words.starts, words.ends)


def _window_text(spaced: Words, start: int, length: int) -> str:
    return spaced.data[spaced.starts[start] : spaced.ends[start + length - 1]].tobytes().decode("utf-8", "replace")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """fp, length, gram_text, items: the distinct windows of (item_id, text)
    rows, each with the sorted distinct ids of the items it occurs in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches):
            words = split_words(column, ALNUM)
            spaced, hashes = single_spaced(words), _hashes(words)
            ids, rows = batch.column(0).to_pylist(), []
            of = np.repeat(np.arange(len(ids)), words.counts)
            for length in np.unique(np.minimum(words.counts, WINDOW)):
                if length:
                    fits = np.minimum(words.counts, WINDOW) == length
                    starts, fps = window_fingerprints(words, hashes, int(length))
                    for s, f in zip(starts.tolist(), fps.astype(np.int64).tolist(), strict=True):
                        if fits[of[s]]:
                            rows.append((f, int(length), _window_text(spaced, s, int(length)), ids[of[s]]))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield to_batch(
                fp=pa.array(columns[0], pa.int64()),
                length=pa.array(columns[1], pa.int32()),
                window_text=pa.array(columns[2], pa.string()),
                item_id=pa.array(columns[3], pa.string()),
            )

    source = benchmark.select(F.col("item_id").cast("string"), "text")
    found = source.mapInArrow(run, "fp long, length int, window_text string, item_id string")
    return found.distinct()


def _screen(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bit table of the benchmark's fingerprints, and the lengths of its windows.

    The table has a fixed size; it is filled by Spark's partial sums of set
    bytes, so no more than its own bytes reach the driver."""
    lengths = [r["length"] for r in windows.select("length").distinct().orderBy("length").collect()]
    slot = F.shiftrightunsigned(F.col("fp"), 64 - FILTER_BITS)
    bits = (
        windows.select(F.shiftright(slot, 6).alias("word"), F.pmod(slot, F.lit(64)).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )
    screen = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for part in bits.toArrow().to_batches():
        screen[part.column(0).to_numpy()] = part.column(1).to_numpy()
    return screen, lengths


def document_windows(docs: DataFrame, screen: np.ndarray, lengths: list[int]) -> DataFrame:
    """For (doc_id, text, text_key) rows: doc_id, text_key, n_words, and the
    windows whose fingerprint passes the screen."""
    shared = docs.sparkSession.sparkContext.broadcast(screen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.view(np.uint64)
        shift = np.uint64(64 - FILTER_BITS)
        for batch, column in slices(batches):
            words = split_words(column, ALNUM)
            hashes, spaced = _hashes(words), None
            of = np.repeat(np.arange(len(column)), words.counts)
            found: list[list[dict]] = [[] for _ in range(len(column))]
            for length in lengths:
                starts, fps = window_fingerprints(words, hashes, length)
                slot = fps >> shift
                on = (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
                for i in np.flatnonzero(on):
                    spaced = spaced or single_spaced(words)
                    s, t = int(starts[i]), of[starts[i]]
                    found[t].append({
                        "fp": int(fps[i].astype(np.int64)),
                        "length": length,
                        "start": s - int(words.first[t]),
                        "window_text": _window_text(spaced, s, length),
                    })
            yield to_batch(
                doc_id=batch.column(0),
                text_key=batch.column(2),
                n_words=words.counts.astype(np.int64),
                windows=pa.array(found, pa.list_(pa.struct([("fp", pa.int64()), ("length", pa.int32()), ("start", pa.int64()), ("window_text", pa.string())]))),
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run,
        f"doc_id {id_type}, text_key long, n_words long, "
        "windows array<struct<fp: bigint, length: int, start: bigint, window_text: string>>",
    )


def _covered(spans: Column) -> Column:
    """Words covered by the union of (start, length) spans sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), s["start"] + s["length"] - F.greatest(s["start"], acc["upto"]))).alias("n"),
        F.greatest(acc["upto"], s["start"] + s["length"]).alias("upto"),
    )
    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items, items (sorted ids) of every row.

    ``benchmark`` has item_id and text; a null id is the text ``null``. Null
    texts have no words and are never hit; equal rows get equal results; an
    empty benchmark hits nothing. Documents with a hit are joined by
    fingerprint and words; hot windows are pre-grouped on the benchmark's side,
    and rows without a possible hit never enter the join."""
    prepare(docs.sparkSession)
    items = pick(benchmark, item_id="item_id", text="text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text"
    )
    windows = cut(benchmark_windows(items), "benchmark-windows")
    screen, lengths = _screen(windows)
    source = pick(docs, doc_id=doc_id, text=text).withColumn("text_key", F.xxhash64("text"))
    rows = cut(document_windows(source, screen, lengths), "document-windows")

    found = rows.where(F.size("windows") > 0).select("doc_id", "text_key", F.explode("windows").alias("w")).select("doc_id", "text_key", "w.*").distinct()
    known = windows.groupBy("fp", "window_text").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    extended = found.join(known, ["fp", "window_text"])
    key = ["doc_id", "text_key"]
    hit = (
        extended.groupBy(*key)
        .agg(
            _covered(F.sort_array(F.collect_set(F.struct("start", "length")))).alias("n_hit"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "n_hit", "items")
    )
    same = rows["doc_id"].eqNullSafe(hit["hit_id"]) & (rows["text_key"] == hit["hit_key"])
    return rows.drop("windows").join(hit, same, "left").select(
        *key, "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def op3_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's rows; items_sha256 hashes the sorted, comma-joined ids."""
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no window
    of the benchmark. Decided per (id, text), so that equal rows go together."""
    found = contamination(docs, benchmark, doc_id, text).where(F.col("n_hit") > 0)
    bad = found.select(F.col("doc_id").alias("_llm_id"), F.col("text_key").alias("_llm_key")).distinct()
    same = docs[doc_id].eqNullSafe(bad["_llm_id"]) & (F.xxhash64(docs[text]) == bad["_llm_key"])
    return docs.join(bad, same, "left_anti")
