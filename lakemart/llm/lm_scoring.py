"""Language-model scores by logistic context mixing, with a token-count base.

A text is a sequence of tokens: its words, then one end. Tokens that the training
texts hold at least twice have a code of ``CODE_BITS`` bits (at most ``KNOWN`` of
them, the most frequent); all others share one code, RARE. A token's code is
predicted bit by bit under four contexts: all texts, the text's class (clusters of
byte-pair histograms; a text's class is coded first), the hashed end of the
preceding token, and the hash of the preceding token itself. ``lm_mixing``
combines the predictions; its weights are learned online over all tokens with the
occurrence itself left out of the counts, so they fit unseen text. A rare token
is then drawn by its count (discounted), or, if it is new, spelled: the bits of
its bytes are predicted under the last one to five bytes (and the class) and
mixed likewise.

How it is spread. The vocabulary (count of every token) is a Spark table that
grows with the corpus. Each text's (preceding token, code) pairs go, packed, to
deals by preceding token; what follows a token in all texts is then in one deal,
which counts, learns and scores its pairs, and answers each text with a sum.
Pairs that are frequent in a bounded sample are counted where they stand and
scored once, by list; which pairs are on the list changes the volume, not the
result. A preceding token of over 1 / ``LARGE_SHARE`` of all tokens is dealt by
the code's first bits too; there are fewer than ``LARGE_SHARE``, and the counts of
their codes' first bits are a table of bounded size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakemart.llm.common import buffers, cut, cut_in_two, discard, fold, prepare, slices, to_batch, trimmed
from lakemart.llm.lm_mixing import CODE_BITS, CodeModel, ContextCounts, Mixer, SpellModel
from lakemart.llm.words import LOWER, NOT_SPACE, Words, single_spaced, split_words, xxh64

#: Tokens with a code of their own, at most; what a task holds of them is 16 bytes each.
KNOWN = (1 << CODE_BITS) - 2
END_CODE, RARE_CODE = 0, (1 << CODE_BITS) - 1
#: Pairs on the list, at most, and texts of the sample that it is made from.
LISTED = 400_000
SAMPLE_TEXTS = 10_000
#: Texts that the clustering's starting centroids come from, about.
CLUSTER_TEXTS = 2000
#: A preceding token of more than 1 / LARGE_SHARE of all tokens is large.
LARGE_SHARE = 1000
#: Classes of texts, as bits; dimensions of a text's histogram; rounds of clustering at most.
CLASS_BITS = 4
CLASSES = 1 << CLASS_BITS
DIMS = 256
ROUNDS = 10
#: A round that moves no centroid's component further is the last.
STILL = 1e-3
#: A pair's key: a hash of the preceding token, one of its last two bytes, the code, the class.
END_BITS = 8
#: Bits of the first hash at most; fewer where there are fewer distinct tokens (64 values for each).
MOST_HASH_BITS = 64 - END_BITS - CODE_BITS - CLASS_BITS
#: Tokens behind one deal, about.
DEAL_TOKENS = 750_000
#: Distinct tokens, or pairs, that a task holds before it hands them on.
HELD_TOKENS = 600_000
#: Tokens that are told apart together.
ENCODED_TOKENS = 600_000
HELD_PAIRS = 1_000_000
#: Rows of one online step; slots of a table that are summed up together.
STEP_ROWS = 16_384
STEP_TOKENS = 8192
BLOCK_ROWS = 16_384
CHUNK = 1 << 16
#: No token is discounted by more than this count.
MOST_DISCOUNT = 0.75
SEED = 42
LOG10_2 = math.log10(2.0)
_FIRST = ContextCounts.TOP_BITS
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ tokens of a slice


def _end_of(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    """``END_BITS`` hashed bits of a token's last two bytes."""
    return ((last.astype(np.uint64) << np.uint64(8) | before) * _MIX) >> np.uint64(64 - END_BITS)


def hash_bits(distinct: int) -> int:
    return min(max(distinct.bit_length() + 6, 20), MOST_HASH_BITS)


def _context(hashes: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - width)) << np.uint64(END_BITS) | ends


#: The hash of an end (no word holds a line feed), and of its end.
END_HASH = xxh64(np.frombuffer(b"\n", np.uint8), np.array([0]), np.array([1]), SEED)
END_END = np.zeros(1, np.uint64)


def token_hash(w: Words) -> np.ndarray:
    """XXH64 of each word with one space after it, as Spark's ``xxhash64`` of such bytes."""
    return xxh64(w.data, w.starts, w.ends + 1, SEED)


def token_array(w: Words) -> pa.Array:
    """The words of single-spaced ``w``, each with the space after it."""
    offsets = np.append(w.starts, w.ends[-1] + 1 if len(w.ends) else 0).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(w.starts), [None, pa.py_buffer(offsets), pa.py_buffer(w.data)])


def with_ends(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Values of the words, with that of an end after each text's."""
    return np.insert(values, first[1:], end[0])


def word_ends(w: Words) -> np.ndarray:
    """``END_BITS`` hashed bits of each word's last two bytes."""
    before = np.where(w.ends - w.starts > 1, w.data[np.maximum(w.ends - 2, 0)], 0)
    return _end_of(w.data[w.ends - 1], before)


def preceding(w: Words, hashes: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """The context of each token of a slice, ends included: what the token before
    it is (an end, for a text's first)."""
    own = with_ends(_context(hashes, ends, width), w.first, _context(END_HASH, END_END, width))
    return np.roll(own, 1)


# ------------------------------------------------------------------ text classes


def histograms(column: pa.Array) -> np.ndarray:
    """Each text's vector of length 1: root frequencies of its hashed byte pairs (A-Z lower-cased)."""
    raw, offsets = buffers(column)
    data = LOWER[raw].astype(np.uint16)
    slot = ((data[:-1] << np.uint16(8) | data[1:]) * np.uint16(40503) >> np.uint16(8)) & np.uint16(DIMS - 1)
    counts = np.zeros((len(column), DIMS), np.int64)
    for t, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if b - a > 1:
            counts[t] = np.bincount(slot[a : b - 1], minlength=DIMS)
    x = np.sqrt(counts.astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def classes_of(column: pa.Array, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(histograms(column) @ centroids.T, axis=1)


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """``k`` centroids (the last one repeated if there are fewer rows), farthest first, then ten rounds."""
    centres = [x[np.argmax(x @ x.mean(axis=0))]]
    nearest = x @ centres[0]
    while len(centres) < min(k, len(x)):
        centres.append(x[np.argmin(nearest)])
        nearest = np.maximum(nearest, x @ centres[-1])
    c = np.array(centres)
    for _ in range(10):
        own = np.argmax(x @ c.T, axis=1)
        c = np.array([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return np.concatenate([c, np.repeat(c[-1:], k - len(c), axis=0)])


def text_classes(docs: DataFrame, texts: int) -> np.ndarray:
    """Centroids of the training texts. Their histograms are written once, a byte a
    dimension; every round reads them all, and its sums of whole numbers alone
    reach the driver. The rounds start from centroids of a bounded sample, in
    which copies of a text count once."""
    spark = docs.sparkSession

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches):
            x = np.rint(histograms(column) * 255).astype(np.uint8)
            yield to_batch(place=batch.column(1), x=pa.array([v.tobytes() for v in x], pa.binary()))

    place = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1_000_000)) / F.lit(1e6)
    train = docs.where("train and text is not null").select("text", place.alias("place"))
    held = cut(train.mapInArrow(counted, "place double, x binary"), "histograms")
    sample = held.where(F.col("place") < min(1.0, CLUSTER_TEXTS / max(texts, 1))).select("x").distinct().toArrow()["x"].to_pylist()
    if not sample:
        discard(held)
        return np.zeros((CLASSES, DIMS), np.float32)
    centres = _cluster(np.stack([np.frombuffer(v, np.uint8) for v in sorted(sample)]).astype(np.float32) / 255, CLASSES)
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(centres)

        def add(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros((CLASSES, DIMS), np.int64)
            for batch in batches:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, DIMS)
                own = np.argmax(x.astype(np.float32) @ shared.value.T, axis=1)
                for k in range(CLASSES):
                    total[k] += x[own == k].sum(axis=0, dtype=np.int64)
            yield from _chunked(0, total)

        total = np.zeros(CLASSES * DIMS, np.int64)
        _summed(held.select("x").mapInArrow(add, "form int, at long, blob binary"), [total])
        shared.destroy()
        total = total.reshape(CLASSES, DIMS).astype(np.float64)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        moved = np.where(norm > 0, total / np.maximum(norm, 1e-12), centres).astype(np.float32)
        still = np.abs(moved - centres).max() < STILL
        centres = moved
        if still:
            break
    discard(held)
    return centres


# ------------------------------------------------------------------ vocabulary


def vocabulary(docs: DataFrame, centroids: np.ndarray) -> DataFrame:
    """token (a word and a space), c (count in training rows), n (in all rows),
    cls (the least class of a training text that it stands in; else of any) of
    (text, train) rows. Tasks add up before the shuffle, so a frequent token is a
    few rows of each task there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        tokens: list[pa.Array] = []
        marks: list[np.ndarray] = []  # of each token: its text's class, and whether it trains

        def encoded() -> pa.Table:
            found = pa.concat_arrays(tokens).dictionary_encode()
            at, mark, distinct = found.indices.to_numpy(), np.concatenate(marks), len(found.dictionary)
            tokens.clear()
            marks.clear()
            cls = np.full(distinct, 2 * CLASSES)
            np.minimum.at(cls, at, mark)
            c = np.bincount(at[mark < CLASSES], minlength=distinct)
            return pa.table({"token": found.dictionary, "c": c, "n": np.bincount(at, minlength=distinct), "cls": cls})

        def summed() -> pa.Table:
            t = pa.concat_tables(held)
            if len(held) > 1:
                t = t.group_by("token", use_threads=False).aggregate([("c", "sum"), ("n", "sum"), ("cls", "min")])
                t = t.select(["token", "c_sum", "n_sum", "cls_min"]).rename_columns(["token", "c", "n", "cls"])
            return t

        for part, column in slices(batches):
            w = single_spaced(split_words(column, NOT_SPACE))
            if not len(w.starts):
                continue
            train = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
            tokens.append(token_array(w))
            marks.append(np.repeat(classes_of(column, centroids) + CLASSES * (1 - train), w.counts))
            if sum(map(len, tokens)) < ENCODED_TOKENS:
                continue
            held.append(encoded())
            if sum(map(len, held)) > HELD_TOKENS:
                yield from _typed(summed()).to_batches(50_000)
                held.clear()
        if tokens:
            held.append(encoded())
        if held:
            yield from _typed(summed()).to_batches(50_000)

    def _typed(t: pa.Table) -> pa.Table:
        return t.cast(pa.schema([("token", pa.binary()), ("c", pa.int64()), ("n", pa.int64()), ("cls", pa.int64())])).combine_chunks()

    counts = docs.mapInArrow(lambda batches: trimmed(run(batches)), "token binary, c long, n long, cls long")
    least = F.pmod(F.min("cls"), F.lit(CLASSES)).cast("int")
    return counts.groupBy("token").agg(F.sum("c").alias("c"), F.sum("n").alias("n"), least.alias("cls"))


def _at_most(counts: DataFrame, most: int, least: int) -> int:
    """The smallest count, ``least`` or more, that no more than ``most`` rows of
    ``counts.c`` reach. Rows are counted by their count (told apart up to 2^20)."""
    sizes = counts.where(F.col("c") >= least).groupBy(F.least("c", F.lit(1 << 20)).alias("c")).count().orderBy(F.desc("c")).collect()
    total, bound = 0, least
    for r in sizes:
        if total + r["count"] > most:
            return max(r["c"] + 1, least)
        total += r["count"]
    return bound


class Lookup:
    """Places of 64-bit values in a set of distinct ones. They are kept in the order
    of a mixed value, with a first place for each of its first bits, so that a
    value is found in two or three steps."""

    def __init__(self, values: np.ndarray):
        mixed = values * _MIX
        order = np.argsort(mixed)
        self.values = np.append(values[order], np.uint64(0))  # the last one ends every search
        self.shift = np.uint64(64 - max(len(values).bit_length(), 1))
        self.first = np.searchsorted(mixed[order], np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64) << self.shift)
        self.first[-1] = len(values)
        self.longest = int(np.diff(self.first).max(initial=0))

    def __len__(self) -> int:
        return len(self.values) - 1

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value; -1 if it is none of the set."""
        slot = ((values * _MIX) >> self.shift).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.where((at < end) & (self.values[at] == values), at, -1)
        open_ = np.flatnonzero((out < 0) & (at + 1 < end))
        for step in range(1, self.longest):
            if not len(open_):
                break
            here = at[open_] + step
            hit = self.values[here] == values[open_]
            out[open_[hit]] = here[hit]
            open_ = open_[~hit & (here + 1 < end[open_])]
        return out


@dataclass
class Known:
    """The tokens with a code: their hashes, each one's code, and the counts by code."""

    hashes: Lookup
    codes: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> Known:
        lookup = Lookup(hashes)
        own = np.full(len(hashes) + 1, RARE_CODE, np.int64)  # the last one is for those without
        own[lookup.find(hashes)] = codes
        return Known(lookup, own, counts)

    def codes_of(self, hashes: np.ndarray) -> np.ndarray:
        """The code of each hashed word; RARE_CODE if it has none."""
        return self.codes[self.hashes.find(hashes)]


@dataclass
class Totals:
    """Sums over the vocabulary."""

    n_train: int  # training tokens, ends included
    distinct: int  # distinct training tokens, the end included
    n_all: int
    rare: int  # training tokens that are RARE
    rare_distinct: int
    discount: float
    ends: int  # training texts
    rarest: int  # count of a token with a code, at least

    @property
    def lessen(self) -> float:
        return math.log10(self.n_train + 0.5 * (self.distinct + 1))

    @property
    def new_rate(self) -> float:
        """The share of new tokens among rare ones: what is taken off the counts."""
        return self.discount * self.rare_distinct / self.rare if self.rare else 1.0


def known_tokens(words: DataFrame, texts: int, training_texts: int) -> tuple[Known, Totals]:
    bound = _at_most(words, KNOWN, 2)
    listed = words.where(F.col("c") >= bound).select(F.xxhash64("token").alias("h"), "c").toArrow()
    hashes, counts = listed["h"].to_numpy().astype(np.int64).view(np.uint64), listed["c"].to_numpy().astype(np.int64)
    rank = np.lexsort([hashes, -counts])  # code 1 is the most frequent
    codes = np.empty(len(rank), np.int64)
    codes[rank] = np.arange(1, len(rank) + 1)
    s = words.agg(
        F.sum("c").alias("c"), F.sum("n").alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice")
    ).first()
    total = s["c"] or 0
    rare, rare_distinct = total - int(counts.sum()), (s["v"] or 0) - len(counts)
    discount = min(MOST_DISCOUNT, (s["once"] + 1) / (s["once"] + 2 * s["twice"] + 1))
    by_code = np.zeros(1 << CODE_BITS, np.int64)
    by_code[codes] = counts
    by_code[END_CODE], by_code[RARE_CODE] = training_texts, rare
    totals = Totals(
        total + training_texts, (s["v"] or 0) + (training_texts > 0), (s["n"] or 0) + texts, rare, rare_distinct, discount, training_texts, bound
    )
    return Known.of(hashes, codes, by_code), totals


def large_contexts(words: DataFrame, totals: Totals, texts: int, width: int) -> np.ndarray:
    """The contexts of tokens with over 1 / LARGE_SHARE of all, ascending."""
    tokens = words.where(F.col("n") * LARGE_SHARE > totals.n_all).select(F.xxhash64("token").alias("h"), F.expr("substring(token, -3, 3)").alias("tail")).collect()
    out = _context(END_HASH, END_END, width).tolist() if texts * LARGE_SHARE > totals.n_all else []
    for r in tokens:
        tail = b"\0\0" + bytes(r["tail"])[:-1]
        end = _end_of(np.array([tail[-1]]), np.array([tail[-2]], np.uint64))
        out += _context(np.array([r["h"]]).view(np.uint64), end, width).tolist()
    return np.unique(np.array(out, np.uint64))


# ------------------------------------------------------------------ pairs


_KEYED = CODE_BITS + CLASS_BITS


def _key(context: np.ndarray, codes: np.ndarray, cls: np.ndarray) -> np.ndarray:
    return context << np.uint64(_KEYED) | (codes << CLASS_BITS | cls).astype(np.uint64)


def _codes_in(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(CLASS_BITS)) & np.uint64((1 << CODE_BITS) - 1)).astype(np.int64)


def listed_pairs(docs: DataFrame, known: Known, centroids: np.ndarray, texts: int, width: int) -> Lookup:
    """Keys of pairs that are frequent in a sample of about ``SAMPLE_TEXTS``
    training texts: a pair on the list has a training count."""
    place = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1_000_000)) / F.lit(1e6)
    sample = docs.where(F.col("train") & (place < min(1.0, SAMPLE_TEXTS / max(texts, 1)))).select("text")
    shared = docs.sparkSession.sparkContext.broadcast((known, centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for _, column in slices(batches):
            held.append(_pairs(column, *shared.value, width)[0])
            if sum(map(len, held)) > HELD_PAIRS:
                yield again(held)
                held = []
        if held:
            yield again(held)

    def again(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        on = counts > 1  # met once here: not for the list
        return to_batch(key=keys[on].view(np.int64), c=counts[on].astype(np.int64))

    counted = cut(sample.mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")), "sampled-pairs")
    bound = _at_most(counted, LISTED, 2)
    keys = np.sort(counted.where(F.col("c") >= bound).select("key").toArrow()["key"].to_numpy().astype(np.int64).view(np.uint64))
    discard(counted)
    return Lookup(keys)


def _pairs(column: pa.Array, known: Known, centroids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """The key of each token with its context, the token's code (ends included), the texts' classes, and the words."""
    w = single_spaced(split_words(column, NOT_SPACE))
    ends, hashes = word_ends(w), token_hash(w)
    cls = classes_of(column, centroids)
    codes = with_ends(known.codes_of(hashes), w.first, np.array([END_CODE]))
    return _key(preceding(w, hashes, ends, width), codes, np.repeat(cls, w.counts + 1)), codes, cls, w


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays in little-endian bytes, compressed together; the first is ascending and held by its steps."""
    first = np.diff(arrays[0], prepend=arrays[0].dtype.type(0)) if len(arrays[0]) else arrays[0]
    parts = [np.array([len(a) for a in arrays], "<i8").tobytes()]
    for a in (first, *arrays[1:]):  # byte planes: the high bytes of small numbers lie together
        parts.append(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, "<i8", len(kinds))
    at, out = 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * width
    out[0] = np.cumsum(out[0], dtype=kinds[0])
    return out


def _deal_of(keys: np.ndarray, large: np.ndarray, deals: int) -> np.ndarray:
    """The deal of each pair: by its context, and the code's first bits if that is large."""
    context = keys >> np.uint64(_KEYED)
    if len(large):
        at = np.minimum(np.searchsorted(large, context), len(large) - 1)
        first = (_codes_in(keys) >> (CODE_BITS - _FIRST)).astype(np.uint64)
        context = context + np.where(large[at] == context, (first + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0))
    return (((context * _MIX) >> np.uint64(32)) % np.uint64(deals)).astype(np.int64)


#: deal of rows that are no deal's: texts, and chunks of the counts that all tasks share.
TEXTS, TABLES = -1, -2
_EMITTED = "deal int, task int, form int, at long, blob binary"


@dataclass
class Setting:
    """What a task needs to emit pairs."""

    known: Known
    centroids: np.ndarray
    listed: Lookup
    large: np.ndarray
    deals: int
    lessen: float
    width: int  # bits of the hash of a preceding token


def emit(docs: DataFrame, setting: Setting, id_type: str) -> DataFrame:
    """One pass over (doc_id, text, train) rows:

    * deal >= 0: packed pairs of a task, each with its text's number and whether
      it trains (form 0), or with a count alone, for pairs on the list (form 1);
    * TEXTS: a slice of texts, from number ``at`` of its task: id, train, bytes,
      class, tokens, base score of tokens with a code, its rare tokens, and in
      ``blob`` its listed pairs;
    * TABLES: chunk ``at`` of the training counts by large context and first bits
      of the code."""
    shared = docs.sparkSession.sparkContext.broadcast(setting)
    columns = f"{_EMITTED}, ids array<{id_type}>, train array<boolean>, n_bytes array<long>, n_tokens array<long>, n_known array<long>, base array<double>, cls array<int>"
    columns += ", rare array<binary>, rare_at array<long>, rare_n array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        task, upto = TaskContext.get().partitionId(), 0
        seen = s.known.counts > 0
        base = np.where(seen, np.log10(s.known.counts + 0.5) - s.lessen, 0.0)
        base[RARE_CODE], seen[RARE_CODE] = 0.0, False
        listed = np.zeros(len(s.listed), np.int64)
        by_large = np.zeros(len(s.large) << _FIRST, np.int64)
        keys, refs, held = [], [], 0

        def row(deal: int, form: int, at: int, blob: bytes, **lists: pa.Array) -> pa.RecordBatch:
            out = {"deal": [deal], "task": [task], "form": [form], "at": [at], "blob": [blob]}
            arrays = [pa.array(v, t) for v, t in zip(out.values(), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)]
            for name, t in _LISTS.items():
                kind = pa.list_(t or to_arrow(batch_id_type))
                one = lists.get(name)
                arrays.append(pa.array([None], kind) if one is None else pa.ListArray.from_arrays([0, len(one)], one.cast(kind.value_type)))
            return pa.RecordBatch.from_arrays(arrays, names=[*out, *_LISTS])

        def dealt(form: int, k: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
            order = np.argsort(k, kind="stable")
            k, values = k[order], values[order]
            deal = _deal_of(k, s.large, s.deals)
            order = np.argsort(deal, kind="stable")
            k, values, deal = k[order], values[order], deal[order]
            ends = np.append(np.flatnonzero(np.diff(deal)) + 1, len(deal))
            start = 0
            for end in ends.tolist() if len(deal) else []:
                yield row(int(deal[start]), form, 0, _pack(k[start:end], values[start:end].astype(np.uint32)))
                start = end

        for batch, column in slices(batches):
            pair, codes, cls, w = _pairs(column, s.known, s.centroids, s.width)
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            sizes = w.counts + 1
            of = np.repeat(np.arange(len(sizes)), sizes)
            trains = train[of]
            if len(s.large):
                context, first = pair >> np.uint64(_KEYED), codes >> (CODE_BITS - _FIRST)
                at = np.minimum(np.searchsorted(s.large, context), len(s.large) - 1)
                on = trains & (s.large[at] == context)
                by_large += np.bincount(at[on] << _FIRST | first[on], minlength=len(by_large))
            where = s.listed.find(pair)
            is_listed = where >= 0
            listed += np.bincount(where[is_listed & trains], minlength=len(listed))
            keys.append(pair[~is_listed])
            refs.append(((of[~is_listed] + upto) << 1 | trains[~is_listed]).astype(np.uint32))
            held += len(keys[-1])
            rare = np.flatnonzero(codes == RARE_CODE)
            word = rare - of[rare]  # its place among the words: an end stands after each text
            t = pa.table({"at": of[rare], "token": token_array(w).take(pa.array(word))}).group_by(["at", "token"]).aggregate([([], "count_all")])
            yield row(
                TEXTS, 0, upto,
                _pack(np.append(0, np.cumsum(np.bincount(of[is_listed], minlength=len(sizes)))).astype(np.int64), where[is_listed].astype(np.uint32)),
                ids=batch.column(0), train=pa.array(train), n_bytes=pa.array(np.diff(buffers(column)[1])), n_tokens=pa.array(sizes),
                n_known=pa.array(np.bincount(of, weights=seen[codes], minlength=len(sizes)).astype(np.int64)),
                base=pa.array(np.bincount(of, weights=base[codes], minlength=len(sizes))), cls=pa.array(cls),
                rare=pc.cast(t["token"], pa.binary()).combine_chunks(), rare_at=pa.array(t["at"].to_numpy() + upto), rare_n=t["count_all"].combine_chunks(),
            )
            upto += len(sizes)
            if held > HELD_PAIRS:
                yield from dealt(0, np.concatenate(keys), np.concatenate(refs))
                keys, refs, held = [], [], 0
        if held:
            yield from dealt(0, np.concatenate(keys), np.concatenate(refs))
        on = np.flatnonzero(listed)
        if len(on):
            yield from dealt(1, s.listed.values[on], listed[on])
        for chunk in range(0, len(by_large), CHUNK):
            part = by_large[chunk : chunk + CHUNK]
            if part.any():
                yield row(TABLES, 0, chunk // CHUNK, zlib.compress(part.tobytes(), 1))

    batch_id_type = docs.schema["doc_id"].dataType
    to_arrow = to_arrow_type
    return docs.mapInArrow(lambda batches: trimmed(run(batches)), columns)


#: The list columns of a slice's row (None: the type of the ids).
_LISTS = {
    "ids": None, "train": pa.bool_(), "n_bytes": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "cls": pa.int32(),
    "rare": pa.binary(), "rare_at": pa.int64(), "rare_n": pa.int64(),
}


def merged_deals(emitted: DataFrame) -> DataFrame:
    """deal, tasks, blob: one row a deal, with its distinct pairs in order (key,
    training count, places) and the texts that each stands in (number of the
    task in ``tasks``, text). Independent of how the texts lay in tasks, but for
    the order of the places."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["task", "form"], kind="stable")
        tasks = sorted(set(rows["task"]))
        nth = {t: i for i, t in enumerate(tasks)}
        keys, texts, of, counted, counts = [], [], [], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for task, form, blob in zip(rows["task"], rows["form"], rows["blob"], strict=True):
            k, v = _unpack(blob, np.uint64, np.uint32)
            if form:
                counted.append(k)
                counts.append(v)
            else:
                keys.append(k)
                texts.append(v)
                of.append(np.full(len(k), nth[task], np.uint32))
        k = np.concatenate([*keys, *counted])
        n = sum(map(len, keys))
        distinct, at = np.unique(k, return_inverse=True)
        ref = np.concatenate([*texts, np.zeros(0, np.uint32)])
        c = np.bincount(at[:n], weights=ref & 1, minlength=len(distinct)) + np.bincount(at[n:], weights=np.concatenate(counts), minlength=len(distinct))
        places = np.bincount(at[:n], minlength=len(distinct))
        order = np.argsort(at[:n], kind="stable")
        blob = _pack(
            distinct, c.astype(np.int64), places.astype(np.uint32), np.concatenate([*of, np.zeros(0, np.uint32)])[order], (ref >> 1)[order]
        )
        return pd.DataFrame({"deal": rows["deal"].iloc[:1].to_numpy(), "tasks": [tasks], "blob": [blob]})

    pairs = emitted.where(F.col("deal") >= 0).select("deal", "task", "form", "blob")
    return pairs.groupBy("deal").applyInPandas(merge, "deal int, tasks array<int>, blob binary")


@dataclass
class Deal:
    """A deal's pairs as arrays."""

    keys: np.ndarray
    c: np.ndarray
    places: np.ndarray
    of: np.ndarray
    texts: np.ndarray

    @staticmethod
    def read(blob: bytes) -> Deal:
        return Deal(*_unpack(blob, np.uint64, np.int64, np.uint32, np.uint32, np.uint32))

    def blocks(self, least: int) -> Iterator[slice]:
        """Stretches of at least ``least`` pairs with each context whole."""
        context = self.keys >> np.uint64(_KEYED)
        ends = np.append(np.flatnonzero(context[1:] != context[:-1]) + 1, len(context))
        start = 0
        while start < len(context):
            end = int(ends[np.searchsorted(ends, min(start + least, len(context)))])
            yield slice(start, end)
            start = end


# ------------------------------------------------------------------ the model


def _larger(batches: Iterator[pa.RecordBatch], rows: int = 16_384) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows``: the work on bits goes by whole batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _chunked(form: int, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A table's chunks that hold anything, as rows (form, at, blob)."""
    flat = table.reshape(-1)
    for at in range(0, len(flat), CHUNK):
        part = flat[at : at + CHUNK].astype(np.int64)
        if part.any():
            yield to_batch(form=pa.array([form], pa.int32()), at=pa.array([at // CHUNK], pa.int64()), blob=pa.array([zlib.compress(part.tobytes(), 1)], pa.binary()))


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition of deals: training counts by hashed end and first bits of the
    code (form 0), and by class and code (form 1)."""
    by_end, by_class = np.zeros((1 << END_BITS) << _FIRST, np.int32), np.zeros(CLASSES << CODE_BITS, np.int32)
    for batch in batches:
        for blob in batch.column(0):
            d = Deal.read(blob.as_py())
            on = np.flatnonzero(d.c)
            keys, c = d.keys[on], d.c[on].astype(np.int32)
            codes = _codes_in(keys)
            end = (keys >> np.uint64(_KEYED)).astype(np.int64) & ((1 << END_BITS) - 1)
            np.add.at(by_end, end << _FIRST | codes >> (CODE_BITS - _FIRST), c)
            np.add.at(by_class, (keys & np.uint64(CLASSES - 1)).astype(np.int64) << CODE_BITS | codes, c)
    yield from _chunked(0, by_end)
    yield from _chunked(1, by_class)


def _chunks(batches: Iterator[pa.RecordBatch], slot_bits: int) -> Iterator[pa.RecordBatch]:
    """A partition's spelling counts, by order and chunk of slots."""
    speller = SpellModel(slot_bits)
    spelled = [np.zeros((2, 1 << b), np.int32) for b in speller.sizes]
    for batch in _larger(batches):
        for a in range(0, len(batch), 8192):
            part = batch.slice(a, 8192)
            speller.count([t[:-1] for t in part.column(0).to_pylist()], part.column(1).to_numpy(), spelled)
    for form, table in enumerate(spelled):
        yield from _chunked(form, table)


def _sum_chunks(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in rows["blob"])
    return rows[["form", "at"]].iloc[:1].assign(blob=[zlib.compress(total.tobytes(), 1)])


def _summed(chunks: DataFrame, tables: list[np.ndarray]) -> None:
    """Add chunks (form, at, blob) up, over two levels in Spark, into ``tables`` of a set size."""
    schema = "form int, at long, blob binary"
    parts = chunks.select("form", "at", "blob", F.floor(F.spark_partition_id() / 64).alias("many"))
    sums = parts.groupBy("form", "at", "many").applyInPandas(_sum_chunks, schema).groupBy("form", "at").applyInPandas(_sum_chunks, schema)
    for batch in sums.toArrow().to_batches():
        for form, at, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(zlib.decompress(blob), np.int64)
            tables[form].reshape(-1)[at * CHUNK : at * CHUNK + len(part)] = part


@dataclass
class Model:
    code: CodeModel
    code_mixer: Mixer
    contexts: ContextCounts
    spell: SpellModel
    spell_mixer: Mixer

    def _block(self, d: Deal, part: slice) -> tuple:
        keys, c = d.keys[part], d.c[part]
        context, codes = (keys >> np.uint64(_KEYED)).astype(np.int64), _codes_in(keys)
        cls = (keys & np.uint64(CLASSES - 1)).astype(np.int64)
        return cls, context & ((1 << END_BITS) - 1), codes, c, self.contexts.counts(context, codes, c)

    def learn_codes(self, d: Deal, mixer: Mixer) -> float:
        """Online steps over a deal's training pairs; the tokens learned from."""
        for part in d.blocks(STEP_ROWS):
            cls, ends, codes, c, following = self._block(d, part)
            on = np.flatnonzero(c)
            if len(on):
                weight = c[on].astype(np.float64)
                some = ((zero[on], one[on]) for zero, one in following)
                for stretch, gate, bit in self.code.bits(cls[on], ends[on], codes[on], some, True):
                    mixer.learn(stretch, gate, bit, weight)
        return float(d.c.sum())

    def learn_spelling(self, tokens: list[bytes], cls: np.ndarray, mixer: Mixer) -> float:
        """Online steps over tokens seen once; the tokens learned from."""
        if tokens:
            of, bits = self.spell.bits(tokens, cls, True)
            for stretch, gate, bit in bits:
                mixer.learn(stretch, gate, bit, np.ones(len(of)))
        return float(len(tokens))

    def log2(self, d: Deal) -> np.ndarray:
        """log2 probability of each pair's code after its context."""
        refined = self.code_mixer.refined()
        out = np.zeros(len(d.keys))
        for part in d.blocks(BLOCK_ROWS):
            cls, ends, codes, _, following = self._block(d, part)
            total = np.zeros(len(codes))
            for stretch, gate, bit in self.code.bits(cls, ends, codes, following, False):
                total += self.code_mixer.log2(refined, stretch, gate, bit)
            out[part] = total
        return out

    def spelled(self, tokens: list[bytes], cls: np.ndarray) -> np.ndarray:
        """log2 probability of each token's bytes."""
        if not tokens:
            return np.zeros(0)
        refined = self.spell_mixer.refined()
        of, bits = self.spell.bits(tokens, cls, False)
        return np.bincount(of, weights=sum(self.spell_mixer.log2(refined, *b) for b in bits), minlength=len(tokens))


def fit(words: DataFrame, emitted: DataFrame, deals: DataFrame, totals: Totals, large: np.ndarray) -> Model:
    """The model: tables of a set size are added up, then each deal (and each
    partition of once-seen tokens, dealt by a hash) learns a mixer of its own,
    and the mixers are averaged by what they learned from. Deals depend on the
    corpus alone, so the weights do not depend on the session's partitions."""
    spark = words.sparkSession
    by_end, by_large, by_class = (np.zeros(n << b, np.int64) for n, b in ((1 << END_BITS, _FIRST), (len(large), _FIRST), (CLASSES, CODE_BITS)))
    _summed(emitted.where(F.col("deal") == TABLES), [by_large])
    _summed(deals.select("blob").mapInArrow(lambda batches: trimmed(_shared_counts(batches)), "form int, at long, blob binary"), [by_end, by_class])
    slot_bits = SpellModel.slot_bits(totals.distinct)
    tokens = words.where("c > 0").select("token", "cls")
    tables = [np.zeros(2 << b, np.int64) for b in SpellModel(slot_bits).sizes]
    _summed(tokens.mapInArrow(lambda batches: trimmed(_chunks(batches, slot_bits)), "form int, at long, blob binary"), tables)
    model = Model(
        CodeModel(by_class.reshape(CLASSES, -1), by_end.reshape(1 << END_BITS, -1)), Mixer.fresh(CodeModel.GATES, CodeModel.PREDICTORS),
        ContextCounts(large.astype(np.int64), by_large.reshape(len(large), 1 << _FIRST)),
        SpellModel(slot_bits, [t.reshape(2, -1) for t in tables]),
        Mixer.fresh(SpellModel.GATES, SpellModel.PREDICTORS),
    )
    del tables
    coded = spark.sparkContext.broadcast(Model(model.code, None, model.contexts, None, None))
    spelling = spark.sparkContext.broadcast(Model(None, None, None, model.spell, None))

    def learned(mixers: DataFrame, mixer: Mixer) -> None:
        """Fill ``mixer`` with the average of rows (seen, weights * seen, hits)."""
        values = F.posexplode("v").alias("at", "x")
        sums = mixers.select(values).groupBy("at").agg(F.sum("x").alias("x")).collect()
        if sums:
            v = np.array([x for _, x in sorted((r["at"], r["x"]) for r in sums)])
            size = mixer.weights.size
            mixer.weights = (v[:size] / v[-1]).reshape(mixer.weights.shape)
            mixer.hits = v[size:-1].reshape(2, -1)

    def row(own: Mixer, seen: float) -> list[float]:
        return np.concatenate([own.weights.ravel() * seen, own.hits.ravel(), [seen]]).tolist()

    def learn_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                own = Mixer.fresh(CodeModel.GATES, CodeModel.PREDICTORS)
                seen = coded.value.learn_codes(Deal.read(blob.as_py()), own)
                if seen:
                    yield to_batch(v=pa.array([row(own, seen)], pa.list_(pa.float64())))

    def learn_spelling(rows: pd.DataFrame) -> pd.DataFrame:
        own, seen = Mixer.fresh(SpellModel.GATES, SpellModel.PREDICTORS), 0.0
        once = sorted((zlib.crc32(t), bytes(t[:-1]), k) for t, k in zip(rows["token"], rows["cls"], strict=True))  # a set order, not the alphabet's
        for a in range(0, len(once), STEP_TOKENS):
            _, tokens, cls = zip(*once[a : a + STEP_TOKENS], strict=True)
            seen += spelling.value.learn_spelling(list(tokens), np.array(cls), own)
        return pd.DataFrame({"v": [row(own, seen)]})

    learned(deals.select("blob").mapInArrow(lambda batches: trimmed(learn_codes(batches)), "v array<double>"), model.code_mixer)
    coded.destroy()
    groups = max(1, math.ceil(totals.distinct / 200_000))
    once = words.where("c = 1").select("token", "cls", F.pmod(F.xxhash64("token"), F.lit(groups)).alias("g"))
    learned(once.groupBy("g").applyInPandas(lambda rows: learn_spelling(rows), "v array<double>"), model.spell_mixer)
    spelling.destroy()  # before the learned model is sent out
    return model


# ------------------------------------------------------------------ scores


def answers(deals: DataFrame, model: Model, listed: Lookup) -> DataFrame:
    """task, blob: what each deal adds to the log2 score of the texts of a task;
    task -1: the log2 of pairs on the list, by their number on it."""
    coder = Model(model.code, model.code_mixer, model.contexts, None, None)
    shared = deals.sparkSession.sparkContext.broadcast((coder, listed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, listed = shared.value
        for batch in batches:
            for tasks, blob in zip(batch.column(0), batch.column(1), strict=True):
                d = Deal.read(blob.as_py())
                log2 = model.log2(d)
                text = d.of.astype(np.int64) << 32 | d.texts
                found, at = np.unique(text, return_inverse=True)
                total = np.bincount(at, weights=np.repeat(log2, d.places), minlength=len(found)).astype(np.float32)
                for i, task in enumerate(tasks.as_py()):
                    a, b = np.searchsorted(found, [i << 32, (i + 1) << 32])
                    if b > a:
                        yield _answer(task, found[a:b] & 0xFFFFFFFF, total[a:b])
                at = listed.find(d.keys)
                on = np.flatnonzero(at >= 0)
                if len(on):
                    order = on[np.argsort(at[on])]
                    yield _answer(-1, at[order], log2[order].astype(np.float32))

    def _answer(task: int, text: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        return to_batch(task=pa.array([task], pa.int32()), blob=pa.array([_pack(text.astype(np.uint32), total)], pa.binary()))

    return deals.select("tasks", "blob").mapInArrow(lambda batches: trimmed(run(batches)), "task int, blob binary")


def _text_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """A task's answers, added up by text."""
    parts = [_unpack(b, np.uint32, np.float32) for b in rows["blob"]]
    text, values = (np.concatenate(x) for x in zip(*parts, strict=True))
    found, at = np.unique(text, return_inverse=True)
    return pd.DataFrame({"task": rows["task"].iloc[0], "at": found.astype(np.int64), "log2": np.bincount(at, weights=values, minlength=len(found))})


def score_texts(docs: DataFrame, train: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, train, n_bytes, n_tokens, n_known, train_tokens, base_score,
    score, total_bits, bits_per_byte of every row; learned from the rows whose
    ``train`` column is true (null: false).

    A null text is empty: one end token. Repeated rows each get their row; a
    null id is passed through. Without training rows base_score is 0. An empty
    table gives no rows. Tokens are told apart by their bytes where they are
    counted, and by 64-bit hashes where a text looks one up."""
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{train}`"), F.lit(False)).alias("train"))
    counted = source.agg(F.count(F.lit(1)).alias("all"), F.count_if("train").alias("train")).first()
    texts = counted["all"]
    centroids = text_classes(source, texts)
    words = cut(vocabulary(source.select("text", "train"), centroids), "vocabulary")
    known, totals = known_tokens(words, texts, counted["train"])
    width = hash_bits(totals.distinct)
    large = large_contexts(words, totals, texts, width)
    listed = listed_pairs(source, known, centroids, texts, width)
    deal_count = max(1, math.ceil(totals.n_all / DEAL_TOKENS))
    id_type = source.schema["doc_id"].dataType.simpleString()
    setting = Setting(known, centroids, listed, large, deal_count, totals.lessen, width)
    pairs, rest = cut_in_two(emit(source, setting, id_type), F.col("deal") >= 0, "emitted")
    deals = cut(merged_deals(pairs), "deals")
    discard(pairs)
    model = fit(words, rest, deals, totals, large)
    told = cut(answers(deals, model, listed), "answers")
    discard(deals)

    by_list = np.zeros(len(listed), np.float32)
    for batch in told.where("task = -1").select("blob").toArrow().to_batches():
        for blob in batch.column(0):
            at, log2 = _unpack(blob.as_py(), np.uint32, np.float32)
            by_list[at] = log2
    by_class = model.code.sizes
    prior = np.log2((by_class + 1) / (by_class.sum() + CLASSES))
    shared = spark.sparkContext.broadcast((by_list, prior, model.spell, model.spell_mixer, totals))
    texts_of = _texts(rest, shared, id_type)
    paired = told.where("task >= 0").groupBy("task").applyInPandas(_text_sums, "task int, at long, log2 double")
    sums = texts_of.join(paired, ["task", "at"], "left").join(_rare_sums(rest, words, totals.rarest - 1, shared), ["task", "at"], "left")
    zero = F.lit(0.0)
    score = (F.col("listed") + F.coalesce("log2", zero) + F.coalesce("rare_log2", zero)) * F.lit(LOG10_2)
    found = sums.select(
        "doc_id", "train", "n_bytes", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(totals.n_train).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"), score.alias("score"),
    )
    bits = F.col("score") / F.lit(-LOG10_2)
    return found.select("*", bits.alias("total_bits"), (bits / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))


def _texts(emitted: DataFrame, shared, id_type: str) -> DataFrame:  # noqa: ANN001
    """One row a text, with the log2 of its class and its listed pairs. An end that no training text has is known to none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_list, prior, _, _, totals = shared.value
        end_base = 0.0 if totals.ends else math.log10(0.5) - totals.lessen
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                cuts, at = _unpack(row["blob"][0].as_py(), np.int64, np.uint32)
                upto = np.append(0.0, np.cumsum(by_list[at], dtype=np.float64))
                lists = {name: row[name].flatten() for name in ("ids", "train", "n_bytes", "n_tokens", "n_known", "base", "cls")}
                n = len(lists["ids"])
                yield to_batch(
                    task=pa.array([row["task"][0].as_py()] * n, pa.int32()), at=row["at"][0].as_py() + np.arange(n),
                    doc_id=lists["ids"], train=lists["train"], n_bytes=lists["n_bytes"], n_tokens=lists["n_tokens"],
                    n_known=lists["n_known"], base=lists["base"].to_numpy() + end_base, listed=upto[cuts[1:]] - upto[cuts[:-1]] + prior[lists["cls"].to_numpy()],
                )

    rows = emitted.where(F.col("deal") == TEXTS).select("task", "at", "blob", "ids", "train", "n_bytes", "n_tokens", "n_known", "base", "cls")
    return rows.mapInArrow(
        run, f"task int, at long, doc_id {id_type}, train boolean, n_bytes long, n_tokens long, n_known long, base double, listed double"
    )


def _rare_sums(emitted: DataFrame, words: DataFrame, most: int, shared) -> DataFrame:  # noqa: ANN001
    """task, at, rare_known, rare_base, rare_log2: the rare tokens of each text,
    joined to the vocabulary (counts up to ``most``) by their bytes; new ones are spelled."""
    zipped = F.explode(F.arrays_zip("rare_at", "rare", "rare_n")).alias("r")
    rows = emitted.where(F.col("deal") == TEXTS).select("task", "at", "cls", zipped)
    rows = rows.select("task", F.col("r.rare_at").alias("to"), F.col("r.rare").alias("token"), F.col("r.rare_n").alias("k"), F.get("cls", (F.col("r.rare_at") - F.col("at")).cast("int")).alias("cls"))
    joined = rows.join(words.where(F.col("c").between(1, most)).select("token", "c"), "token", "left").select("task", F.col("to").alias("at"), "token", "k", "c", "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, spell, mixer, totals = shared.value
        model = Model(None, None, None, spell, mixer)
        for batch in _larger(batches):
            c = batch["c"].fill_null(0).to_numpy()
            k = batch["k"].to_numpy()
            rate = totals.new_rate
            with np.errstate(divide="ignore"):
                log2 = np.log2(np.maximum(c - totals.discount, 1e-9) / max(totals.rare, 1))
            new = np.flatnonzero(c == 0)
            tokens = [t[:-1] for t in batch["token"].take(pa.array(new)).to_pylist()]
            cls = batch["cls"].to_numpy()[new]
            for a, b in _byte_slices(tokens):
                log2[new[a:b]] = math.log2(rate) + model.spelled(tokens[a:b], cls[a:b])
            yield to_batch(
                task=batch["task"], at=batch["at"], known=np.where(c > 0, k, 0), base=k * (np.log10(c + 0.5) - totals.lessen), log2=k * log2
            )

    each = joined.mapInArrow(lambda batches: trimmed(run(batches)), "task int, at long, known long, base double, log2 double")
    return each.groupBy("task", "at").agg(F.sum("known").alias("rare_known"), F.sum("base").alias("rare_base"), F.sum("log2").alias("rare_log2"))


def _byte_slices(tokens: list[bytes], most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Stretches of about ``most`` bytes, a token at least."""
    a = size = 0
    for b, t in enumerate(tokens):
        if size and size + len(t) > most:
            yield a, b
            a, size = b, 0
        size += len(t) + 1
    if tokens:
        yield a, len(tokens)


def op2_lm_scoring(docs: DataFrame) -> DataFrame:
    """The contract's rows; the held-out fold is crc32 mod 5 = 1."""
    rows = docs.select("doc_id", "text", (fold(F.col("doc_id")) != 1).alias("train"))
    found = score_texts(rows, "train")
    return found.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "total_bits", "bits_per_byte"
    )
