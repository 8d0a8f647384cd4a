"""SimHash near-duplicates by a binary trie self-join.

A text's fingerprint has bit i set if over half of its word shingles' XXH64
values have it. Distinct fingerprints are dealt into groups that agree on two of
six bit blocks: two fingerprints that differ in at most four bits agree on two
blocks at least, so every link lies within a group. A group is a binary trie; pairs of
nodes are walked down together, level by level, adding up the bits in which
their prefixes differ and dropping a pair as soon as the sum passes the bit
budget. The links found give connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import cut, discard, pick, slices, prepare, to_batch
from lakemart.llm.components import components
from lakemart.llm.words import NOT_SPACE, single_spaced, split_words, xxh64

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Rows of one side of a group's task; a larger group is worked off in pairs of parts.
PART = 1024
#: A node pair of at most this many leaf pairs is compared directly.
LEAF_PAIRS = 32
#: Rows that a task of the join works off, about.
TASK_ROWS = 8192
_ONES = np.uint64(0x0101010101010101)


def fingerprints(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text of a large-binary array; zero without words."""
    w = single_spaced(split_words(column, NOT_SPACE))
    counts = w.counts
    shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    of = np.repeat(np.arange(len(counts)), shingles)
    begin = np.cumsum(shingles) - shingles
    lead = np.arange(len(of)) - begin[of] + w.first[of]
    last = np.minimum(lead + shingle, w.first[of + 1]) - 1
    hashes = xxh64(w.data, w.starts[lead], w.ends[last], SEED)
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(shingles)
    if not len(full):
        return out
    # eight counters in the bytes of a word: no more than 255 rows are added up at a time
    parts = (shingles[full] + 254) // 255
    part_of = np.repeat(np.arange(len(full)), parts)
    nth = np.arange(len(part_of)) - np.repeat(np.cumsum(parts) - parts, parts)
    cuts = begin[full][part_of] + 255 * nth
    rows = np.cumsum(parts) - parts
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _ONES, cuts)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), rows, axis=0)
        for byte in range(8):
            set_ = sums[:, byte] * 2 > shingles[full]
            out[full] |= set_.astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


#: Blocks that the values of a group agree on. A value is in 15 groups of four
#: allowed bits; they are cut into parts from 2 billion values on (1024 x 2^21).
AGREE = 2


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of max_bits + AGREE blocks that cover the 64 bits."""
    n = max_bits + AGREE
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def masks(max_bits: int) -> list[int]:
    """The bits (as a signed long) of every choice of AGREE blocks."""
    each = [((1 << width) - 1) << first for first, width in blocks(max_bits)]
    return [(m - (1 << 64) if m >> 63 else m) for m in map(sum, combinations(each, AGREE))]


def trie_links(values: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j whose values differ in at most ``max_bits`` bits, from
    the given pairs of tries.

    A trie is a range of ``values`` that is sorted and distinct; ``a`` and ``b``
    are (2, n) arrays of range bounds, pair by pair; a pair is one range with
    itself, or an earlier range with a later one. A node is a range too: bit d
    parts it where that bit turns to one."""
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    errors = np.zeros(a.shape[1], np.int64)
    for depth in range(65):
        size = (a[1] - a[0]) * (b[1] - b[0])
        done = (size <= LEAF_PAIRS) | (depth == 64)
        n = size[done]
        pair = np.repeat(np.flatnonzero(done), n)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        width = (b[1] - b[0])[pair]
        i, j = a[0][pair] + k // np.maximum(width, 1), b[0][pair] + k % np.maximum(width, 1)
        near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= max_bits)
        found_i.append(i[near])
        found_j.append(j[near])
        a, b, errors = a[:, ~done], b[:, ~done], errors[~done]
        if not len(errors):
            break
        ones = np.append(0, np.cumsum((values >> np.uint64(63 - depth)) & np.uint64(1))).astype(np.int64)
        am, bm = a[1] - (ones[a[1]] - ones[a[0]]), b[1] - (ones[b[1]] - ones[b[0]])
        zero_a, one_a, zero_b, one_b = np.stack([a[0], am]), np.stack([am, a[1]]), np.stack([b[0], bm]), np.stack([bm, b[1]])
        a, b = np.concatenate([zero_a, one_a, zero_a, one_a], axis=1), np.concatenate([zero_b, one_b, one_b, zero_b], axis=1)
        errors = np.concatenate([errors, errors, errors + 1, errors + 1])
        keep = (a[1] > a[0]) & (b[1] > b[0]) & (errors <= max_bits) & (a[0] <= b[0])  # each unordered pair once
        a, b, errors = a[:, keep], b[:, keep], errors[keep]
    return np.concatenate(found_i), np.concatenate(found_j)


def forest(nodes: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For links i-j among ``nodes`` nodes, the least node of each one's component."""
    root = np.arange(nodes)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (root == before).all():
            break
    return root


def deal(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, own, block, value, p, q, task: each value of ``distinct.fp`` in every
    group that it belongs to, for every pair (p, q) of the group's parts with its
    own one. Tasks are as many as the rows dealt ask for: about ``TASK_ROWS`` each,
    and no pair of parts is larger than 2 * PART or so."""
    choices = F.array(*[F.lit(m).cast("long") for m in masks(max_bits)])
    keyed = distinct.select("fp", F.posexplode(choices).alias("block", "mask")).select("fp", "block", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
    # Groups over PART rows are cut into parts by a hash; a task meets two of them at a time.
    parts = F.ceil(F.col("count") / PART).cast("int").alias("parts")
    large = cut(keyed.groupBy("block", "value").count().where(F.col("count") > PART).select("block", "value", "count", parts), "large-groups")
    more = large.agg(F.coalesce(F.sum(F.col("count") * (F.col("parts") - 1)), F.lit(0))).first()[0]
    rows = len(masks(max_bits)) * distinct.count() + more  # dealt below
    sized = keyed.join(large.drop("count"), ["block", "value"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("own")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    pair = ["block", "value", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q")]
    dealt = sized.select("*", own).select("*", other).select("fp", "own", *pair)
    return dealt.select("*", F.pmod(F.xxhash64("block", "value", "p", "q"), F.lit(math.ceil(rows / TASK_ROWS) or 1)).alias("task"))


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b (longs): links that join every two values of ``distinct.fp`` that
    differ in at most ``max_bits`` bits into one component, and no others. Each
    group yields a forest, not all its pairs."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        """Works off all groups of a task at once."""
        block, value, p, q, own = (rows[c].to_numpy(np.int64) for c in ("block", "value", "p", "q", "own"))
        fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
        order = np.lexsort([fps, own, q, p, value, block])
        keys = np.stack([block, value, p, q, own])[:, order]
        fps = fps[order]
        start = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
        ranges = np.stack([start, np.append(start[1:], len(fps))])
        k = keys[:, start]
        alone = np.flatnonzero(k[2] == k[3])  # a part with itself
        two = np.flatnonzero((k[:4, 1:] == k[:4, :-1]).all(axis=0))  # a part with the next one
        first, second = np.append(alone, two), np.append(alone, two + 1)
        i, j = trie_links(fps, ranges[:, first], ranges[:, second], max_bits)
        root = forest(len(fps), i, j)
        on = np.flatnonzero(root != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[on].view(np.int64), "b": fps[root[on]].view(np.int64)})

    return deal(distinct, max_bits).groupBy("task").applyInPandas(join, "a long, b long")


def _members(docs: DataFrame, doc_id: str, text: str, shingle: int, max_bits: int) -> DataFrame:
    """doc_id, text_key, fp, root (the least fingerprint reachable) of every row."""
    prepare(docs.sparkSession)
    source = pick(docs, doc_id=doc_id, text=text).withColumn("text_key", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches):
            yield to_batch(doc_id=batch.column(0), text_key=batch.column(2), fp=fingerprints(column, shingle).view(np.int64))

    id_type = source.schema["doc_id"].dataType.simpleString()
    rows = cut(source.mapInArrow(run, f"doc_id {id_type}, text_key long, fp long"), "fingerprints")
    values = cut(rows.select("fp").distinct(), "distinct-fingerprints")
    linked = components(near_links(values, max_bits))
    roots = rows.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    members = cut(roots.select("doc_id", "text_key", "fp", F.coalesce("root", "fp").alias("root")), "members")
    discard(rows, values)
    return members


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """doc_id, fp (long), component_id of every row: the least id reachable over
    texts whose fingerprints differ in at most ``max_bits`` bits.

    Null and word-less texts have fingerprint zero and are linked like others.
    Rows with a null id get the component's least id (null if it has none);
    equal rows share a component. Rows of one fingerprint are combined before
    any shuffle of links, so a large group of copies is one value there."""
    rows = _members(docs, doc_id, text, shingle, max_bits)
    least = cut(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least-ids")
    return rows.join(least, "root").select("doc_id", "fp", "component_id")


def op6_simhash_dedup(docs: DataFrame) -> DataFrame:
    """The contract's rows: doc_id, fingerprint as hex digits, component_id."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of ``docs``, with all its columns, of each component: the one
    with the least id (null ids last; then the least text hash), and of equal
    rows one."""
    rows = _members(docs, doc_id, text, shingle, max_bits)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", F.col("count").alias("n"))
    kept = rows.groupBy("root", "doc_id", "text_key").count().groupBy("root").agg(F.min(key).alias("k"))
    kept = cut(kept.select(F.col("k.doc_id").alias("_llm_id"), F.col("k.text_key").alias("_llm_key"), F.col("k.n").alias("_llm_n")), "kept")
    same = docs[doc_id].eqNullSafe(kept["_llm_id"]) & (F.xxhash64(docs[text]) == kept["_llm_key"])
    once = docs.join(kept.where("_llm_n = 1"), same, "left_semi")
    # rows that repeat with id and text: one of them
    again = docs.join(kept.where("_llm_n > 1"), same).dropDuplicates(["_llm_id", "_llm_key"])
    return once.unionByName(again.drop("_llm_id", "_llm_key", "_llm_n"))
