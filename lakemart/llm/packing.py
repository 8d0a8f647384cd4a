"""Best-fit packing with a grouping genetic algorithm on islands.

Documents become token ids and pieces of at most one sequence's length. Pieces
are dealt into shards; several islands each evolve packings of a shard. A
packing is a list of bins; crossover injects whole well-filled bins of one
parent into another, removes the bins that share pieces with them, and puts the
displaced pieces back: first in exchange for smaller ones where that fills a bin
better, then into new bins filled as closely as two or three pieces can, the
rest by best fit. An island goes on until some generations in a row bring
nothing; between epochs each island's elite migrates to the next island. The least-filled bin of every shard goes into a further
round with those of the other shards, until one shard is left.
"""

from __future__ import annotations

import math
import os
import random
import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import cut, pick, prepare, slices, to_batch
from lakemart.llm.token_counts import Merger

#: About so many bytes of text are encoded together (one text at least).
BLOCK_BYTES = 16 << 20
MARKS = string.punctuation
#: Letters of ASCII and Latin-1, and the same as UTF-8 bytes.
LETTERS = string.ascii_letters + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
WORD = r"^(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+$"


@dataclass(frozen=True)
class Params:
    capacity: int = 4096
    end_id: int = 1
    shard_pieces: int = 2048
    islands: int = 2
    epochs: int = 2
    population: int = 4
    #: Generations in a row without a better packing that end an island's epoch.
    patience: int = 10
    #: Tasks that the islands of all shards are spread over, at most.
    tasks: int = 4096


# ------------------------------------------------------------------ token ids


def gather(pool: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The items ``which`` of a ragged array in a row, and their sizes."""
    n = size[which]
    first = np.cumsum(size) - size
    at = np.repeat(first[which] - (np.cumsum(n) - n), n)
    at += np.arange(len(at))
    return pool[at], n


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file.

    ASCII white space ends every token, so a text's ids are those of its chunks
    between white space. A block's distinct chunks are cut into a word of Latin
    letters, which counts in lower case, and the marks that close it: each is a
    pre-token of its own whatever its neighbours. The library encodes distinct
    words, runs of marks and other chunks once a block."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.symbols = dict(enumerate(Merger.byte_symbols()))

    def _ids(self, items: pa.Array) -> list[list[int]]:
        """Ids of distinct items. A word is its own pre-token, so the library's
        model alone gives its ids."""
        words = pc.match_substring_regex(items.view(pa.large_binary()), WORD).to_pylist()
        found: list[list[int]] = []
        rest = []
        tokens = self.library.model.tokenize
        for n, (item, word) in enumerate(zip(items.view(pa.large_binary()).to_pylist(), words, strict=True)):
            if not word:
                rest.append((n, item.decode("utf-8", "replace")))
                found.append([])
                continue
            symbols = item.decode().lower()
            if not item.isascii():
                symbols = symbols.encode().decode("latin-1").translate(self.symbols)
            found.append([t.id for t in tokens(symbols)])
        for a in range(0, len(rest), 10_000):
            part = rest[a : a + 10_000]
            encoded = self.library.encode_batch_fast([text for _, text in part], add_special_tokens=False)
            for (n, _), e in zip(part, encoded, strict=True):
                found[n] = e.ids
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a large-binary array in a row, and the n + 1
        bounds of the texts."""
        split = pc.ascii_split_whitespace(texts.view(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary
        words = pc.ascii_rtrim(chunks, MARKS)
        plain = pc.match_substring_regex(words.view(pa.large_binary()), WORD)
        words = pc.if_else(plain, pc.ascii_lower(words), chunks).dictionary_encode()
        marks = pc.if_else(plain, pc.ascii_ltrim(chunks, LETTERS), "").dictionary_encode()
        ids = self._ids(words.dictionary) + self._ids(marks.dictionary)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        pool = np.fromiter(chain.from_iterable(ids), "<u4", int(size.sum()))
        # a chunk is its word and its marks, a text its chunks
        parts = np.stack([words.indices.to_numpy(), len(words.dictionary) + marks.indices.to_numpy()], axis=1)
        pool, size = gather(pool, size, parts.ravel())
        pool, size = gather(pool, size[0::2] + size[1::2], coded.indices.to_numpy())
        chunk_ends = np.append(0, np.cumsum(size))
        return pool, chunk_ends[np.append(0, np.cumsum(split.value_lengths().to_numpy()))]


#: Kept by a Python worker from task to task.
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts (as large binary) of about ``BLOCK_BYTES`` of text at a time."""
    ids, texts, size = [], [], 0
    for batch, column in slices(batches):
        ids.append(batch.column(0))
        texts.append(column)
        size += pc.sum(pc.binary_length(column)).as_py() or 0
        if size >= BLOCK_BYTES:
            yield pa.concat_arrays(ids), pa.concat_arrays(texts)
            ids, texts, size = [], [], 0
    if ids:
        yield pa.concat_arrays(ids), pa.concat_arrays(texts)


def token_pieces(docs: DataFrame, tokenizer: str, p: Params, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids with the end
    id, cut where they pass the capacity. A null text is empty: one end id."""
    prepare(docs.sparkSession)
    source = pick(docs, doc_id=doc_id, text=text)
    end = np.array([p.end_id], "<u4").tobytes()
    width = 4 * p.capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for doc_ids, texts in blocks(batches):
            pool, bounds = encode(texts)
            of, piece, start, length, crc = [], [], [], [], []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                ids = pool[a:b].tobytes() + end
                for n, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    of.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield to_batch(
                doc_id=doc_ids.take(pa.array(of, pa.int64())), piece=pa.array(piece, pa.int32()),
                start=pa.array(start, pa.int64()), length=pa.array(length, pa.int64()), ids_crc32=pa.array(crc, pa.int64()),
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


# ------------------------------------------------------------------ one island

Bin = list[int]


def best_fit(bins: list[Bin], pieces: list[int], lengths: list[int], capacity: int) -> list[Bin]:
    """Put each piece, longest first, into the bin it fills best; a new one if none has room."""
    free = sorted((capacity - sum(lengths[i] for i in b), n) for n, b in enumerate(bins))
    for i in sorted(pieces, key=lambda i: (-lengths[i], i)):
        need = lengths[i]
        at = bisect_left(free, (need, -1))
        if at < len(free):
            room, n = free.pop(at)
            bins[n].append(i)
            insort(free, (room - need, n))
        else:
            bins.append([i])
            insort(free, (capacity - need, len(bins) - 1))
    return bins


def fills(bins: list[Bin], lengths: list[int]) -> list[int]:
    return [sum(lengths[i] for i in b) for b in bins]


def fitness(bins: list[Bin], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first; then the fuller the full ones, the better."""
    return -len(bins), sum((f / capacity) ** 2 for f in fills(bins, lengths))


def exchange(bins: list[Bin], pieces: list[int], lengths: list[int], capacity: int) -> list[int]:
    """Swap displaced ``pieces`` into bins in place of one or two smaller ones
    wherever a bin gets fuller, the fullest way of each bin; what is left over."""
    out = sorted((lengths[i], i) for i in pieces)
    for b in bins:
        room = capacity - sum(lengths[i] for i in b)
        if not room or not out:
            continue
        best = (0, -1, ())  # gain, place of the displaced piece, what it replaces
        small = [(lengths[i], (i,)) for i in b]
        if len(b) <= 8:
            small += [(lengths[i] + lengths[j], (i, j)) for n, i in enumerate(b) for j in b[:n]]
        for size, old in small:
            at = bisect_left(out, (size + room + 1, -1)) - 1
            if at >= 0 and out[at][0] - size > best[0]:
                best = (out[at][0] - size, at, old)
        if best[0] > 0:
            _, new = out.pop(best[1])
            for i in best[2]:
                b.remove(i)
                insort(out, (lengths[i], i))
            b.append(new)
    return [i for _, i in out]


def fill_closely(pieces: list[int], lengths: list[int], capacity: int, rng: random.Random | None = None) -> list[Bin]:
    """New bins for ``pieces``: each begins with the longest one left (with
    ``rng``, now and then one of the next few) and takes the piece or the two
    that fill it best, until none fits."""
    left = sorted(pieces, key=lambda i: (lengths[i], i))
    size = np.array([lengths[i] for i in left], np.int64)
    bins = []
    while left:
        at = len(left) - 1
        if rng is not None and rng.random() < 0.2:
            at = rng.randrange(max(0, len(left) - 8), len(left))
        chosen = [at]
        room = capacity - int(size[at])
        while True:
            upto = int(np.searchsorted(size, room, side="right"))
            if not upto:
                break
            free = np.ones(upto, bool)
            free[[i for i in chosen if i < upto]] = False
            on = np.flatnonzero(free)
            if not len(on):
                break
            have = size[on]
            other = np.searchsorted(have, room - have, side="right") - 1  # the longest that fits beside
            other = np.where(other == np.arange(len(on)), other - 1, other)
            pair = np.where(other >= 0, have + have[np.maximum(other, 0)], 0)
            best = int(np.argmax(pair))
            if pair[best] > have[-1]:
                added = [int(on[best]), int(on[other[best]])]
            else:
                added = [int(on[-1])]
            chosen += added
            room -= int(size[added].sum())
        bins.append([left[i] for i in chosen])
        keep = np.ones(len(left), bool)
        keep[chosen] = False
        size = size[keep]
        left = [i for i, k in zip(left, keep.tolist()) if k]
    return bins


def put_back(bins: list[Bin], pieces: list[int], lengths: list[int], capacity: int, rng: random.Random) -> list[Bin]:
    """``bins`` with the displaced ``pieces`` in them again: by exchange, then as
    closely filled new bins, the poorer of which are dissolved by best fit."""
    left = exchange(bins, pieces, lengths, capacity)
    new = fill_closely(left, lengths, capacity, rng)
    close = [b for b in new if sum(lengths[i] for i in b) * 50 >= capacity * 49]
    rest = [i for b in new if sum(lengths[i] for i in b) * 50 < capacity * 49 for i in b]
    return best_fit(bins + close, rest, lengths, capacity)


def crossover(a: list[Bin], b: list[Bin], lengths: list[int], capacity: int, rng: random.Random) -> list[Bin]:
    full = sorted(range(len(b)), key=lambda n: -sum(lengths[i] for i in b[n]))
    take = rng.sample(full[: max(1, len(full) // 2)], max(1, len(full) // 4))
    injected = [list(b[n]) for n in sorted(take)]
    inside = {i for x in injected for i in x}
    kept, displaced = [], []
    for x in a:
        if inside.isdisjoint(x):
            kept.append(list(x))
        else:
            displaced += [i for i in x if i not in inside]
    return put_back(injected + kept, displaced, lengths, capacity, rng)


def mutate(a: list[Bin], lengths: list[int], capacity: int, rng: random.Random) -> list[Bin]:
    """Empty the least-filled tenth of the bins and some others, and put their pieces back."""
    filled = fills(a, lengths)
    poor = sorted(range(len(a)), key=filled.__getitem__)[: max(1, len(a) // 10)]
    drop = {*poor, *rng.sample(range(len(a)), min(max(3, len(a) // 20), len(a)))}
    return put_back([list(x) for n, x in enumerate(a) if n not in drop], [i for n in sorted(drop) for i in a[n]], lengths, capacity, rng)


def evolve(lengths: list[int], elites: list[list[Bin]], p: Params, rng: random.Random) -> list[Bin]:
    """One island's epoch from its own and the arrived elites; the best packing."""
    least = math.ceil(sum(lengths) / p.capacity)
    everything = list(range(len(lengths)))
    people = list(elites) or [best_fit([], everything, lengths, p.capacity)]

    def score(x: list[Bin]) -> tuple[int, float]:
        return fitness(x, lengths, p.capacity)

    best = max(people, key=score)
    if len(best) == least:
        return best
    while len(people) < p.population:  # unlike parents: bins filled closely from different beginnings
        people.append(fill_closely(everything, lengths, p.capacity, rng if len(people) > 1 else None))
    people.sort(key=score, reverse=True)
    best, idle = people[0], 0
    while idle < p.patience and len(best) > least:
        a, b = rng.sample(people, 2)
        child = crossover(a, b, lengths, p.capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, lengths, p.capacity, rng)
        bins = len(best)
        people = sorted([*people, child, mutate(best, lengths, p.capacity, rng)], key=score, reverse=True)[: p.population]
        best = people[0]
        idle = 0 if len(best) < bins else idle + 1
    return best


def _to_bins(labels: np.ndarray) -> list[Bin]:
    order = np.argsort(labels, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(labels[order])) + 1)
    return [x.tolist() for x in parts if len(x)]


def _to_labels(bins: list[Bin], n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for k, b in enumerate(bins):
        out[b] = k
    return out


# ------------------------------------------------------------------ all shards


def _pack_shards(shards: DataFrame, count: int, p: Params) -> DataFrame:
    """shard, labels: the bin of each piece of a shard's ``lengths``, evolved on
    ``islands`` islands with migration between epochs. An island's work is large
    beside its bytes, so the number of tasks is set from the ``count`` of shards."""
    each = F.explode(F.sequence(F.lit(0), F.lit(p.islands - 1))).alias("island")
    state = shards.select("shard", "lengths", F.lit(None).cast("array<array<int>>").alias("elites")).select("*", each)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for shard, lengths, elites, island in frame[["shard", "lengths", "elites", "island"]].itertuples(index=False):
                lengths = [int(x) for x in lengths]
                rng = random.Random(int(shard) * 1009 + int(island))
                people = [] if elites is None else [_to_bins(np.asarray(e)) for e in elites]
                out.append(_to_labels(evolve(lengths, people, p, rng), len(lengths)))
            yield frame[["shard", "lengths", "island"]].assign(labels=out)

    bins = F.array_max("labels")
    for epoch in range(p.epochs):
        done = state.repartition(min(count * p.islands, p.tasks), "shard", "island").mapInPandas(run, "shard long, lengths array<bigint>, island int, labels array<int>")
        if epoch + 1 < p.epochs:
            # an island's elite goes to the next island and also stays
            moved = F.explode(F.array("island", F.pmod(F.col("island") + 1, F.lit(p.islands)))).alias("to")
            arrived = done.select("shard", "lengths", "labels", moved)
            state = arrived.groupBy("shard", F.col("to").alias("island")).agg(
                F.first("lengths").alias("lengths"), F.collect_list("labels").alias("elites")
            )
    best = F.min_by("labels", F.struct(bins, F.col("island")))
    return done.groupBy("shard").agg(best.alias("labels"))


def _offsets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Offsets of the pieces in their bins, and each shard's least-filled bin."""
    for frame in frames:
        offsets, least = [], []
        for lengths, labels in zip(frame["lengths"], frame["labels"], strict=True):
            lengths, labels = np.asarray(lengths), np.asarray(labels)
            order = np.argsort(labels, kind="stable")
            total = np.cumsum(lengths[order]) - lengths[order]
            first = np.append(True, np.diff(labels[order]) != 0)
            offset = np.zeros(len(lengths), np.int64)
            offset[order] = total - np.maximum.accumulate(np.where(first, total, 0))
            offsets.append(offset)
            least.append(int(np.argmin(np.bincount(labels, weights=lengths))))
        yield frame[["shard"]].assign(labels=frame["labels"], offsets=offsets, least=least)


def pack(pieces: DataFrame, p: Params = Params()) -> DataFrame:
    """``pieces`` (with a long ``length`` of 1 to the capacity) with sequence_id
    and offset. Pieces of full length are sequences of their own.

    Pieces are dealt to shards by their place in the written table, so equal
    rows or a hot document spread over all shards."""
    prepare(pieces.sparkSession)
    pieces = cut(pieces, "pieces").withColumn("_llm_item", F.monotonically_increasing_id())
    full = pieces.where(F.col("length") == p.capacity)
    columns = [c for c in pieces.columns if c != "_llm_item"]
    out = full.select(*columns, (-1 - F.col("_llm_item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    current, turn = pieces.where(F.col("length") < p.capacity), 0
    n = current.count()
    while n:
        shards = math.ceil(n / p.shard_pieces)
        dealt = current.groupBy(F.pmod(F.xxhash64("_llm_item", F.lit(turn)), F.lit(shards)).alias("shard")).agg(
            F.collect_list(F.struct(*pieces.columns)).alias("items")
        )
        dealt = cut(dealt.select("*", F.col("items")["length"].alias("lengths")), "shards")
        labels = _pack_shards(dealt.select("shard", "lengths"), shards, p)
        placed = dealt.select("shard", "lengths").join(labels, "shard").mapInPandas(
            _offsets, "shard long, labels array<int>, offsets array<bigint>, least int"
        )
        rows = dealt.drop("lengths").join(placed, "shard").select(
            "shard", "least", F.explode(F.arrays_zip("items", "labels", "offsets")).alias("z")
        )
        rows = cut(rows.select("shard", "least", F.col("z.labels").alias("label"), F.col("z.offsets").alias("offset"), "z.items.*"), "packed")
        again = (F.col("label") == F.col("least")) & F.lit(shards > 1)
        sequence = F.lit(turn << 52) + F.col("shard") * F.lit(p.shard_pieces * 2) + F.col("label")
        out = out.unionByName(rows.where(~again).select(*columns, sequence.alias("sequence_id"), "offset"))
        current, turn = rows.where(again).select(*pieces.columns), turn + 1
        n = current.count()
    return out


def op10_best_fit_packing(docs: DataFrame, tokenizer: str, p: Params = Params()) -> DataFrame:
    """The contract's rows. Repeated rows each get their pieces; a null id is passed through."""
    found = pack(token_pieces(docs, tokenizer, p), p)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
