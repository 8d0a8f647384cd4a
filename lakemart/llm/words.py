"""Words of a batch of texts as numpy arrays, and XXH64 over byte spans."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from lakemart.llm.common import buffers

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of a word for `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Bytes of a word for `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
ALNUM = np.ones(256, bool)
ALNUM[0x00:0x30] = False
ALNUM[0x3A:0x61] = False
ALNUM[0x7B:0x80] = False


@dataclass
class Words:
    """Words of n texts: ``data`` lower-cased bytes; word i is
    ``data[starts[i]:ends[i]]``; text t has words ``first[t]:first[t + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(column: pa.Array, is_word: np.ndarray) -> Words:
    raw, offsets = buffers(column)
    data = LOWER[raw]
    inside = is_word[data]
    edge = np.zeros(len(data) + 1, bool)  # a text begins here
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def single_spaced(w: Words) -> Words:
    """The same words with exactly one space byte after each."""
    lengths = w.ends - w.starts
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    data = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
    shift = np.repeat(w.starts - starts, lengths)
    to = np.arange(len(shift)) + np.repeat(np.arange(len(lengths)), lengths)
    data[to] = w.data[to + shift]
    return Words(data, starts, ends, w.first)


# Fixed values of XXH64.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)
LONG_SPAN = 4096
SPAN_BLOCK = 8192


def _rot(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rot(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of every span ``data[starts[i]:ends[i]]``, in blocks that fit the cache."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(starts), np.uint64)
    for i in range(0, len(starts), SPAN_BLOCK):
        out[i : i + SPAN_BLOCK] = _xxh64(data, padded, starts[i : i + SPAN_BLOCK], ends[i : i + SPAN_BLOCK], seed)
    return out


def _xxh64(data: np.ndarray, padded: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    n = len(data) + 1
    u64 = np.ndarray((n,), "<u8", padded, strides=(1,))
    u32 = np.ndarray((n,), "<u4", padded, strides=(1,))
    at = starts.astype(np.int64)
    size = (ends - starts).astype(np.int64)
    seed = np.uint64(seed)
    with np.errstate(over="ignore"):
        h = np.full(len(at), seed + P5, np.uint64)
        wide = np.flatnonzero((size >= 32) & (size < LONG_SPAN))
        if len(wide):
            acc = [np.full(len(wide), s, np.uint64) for s in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            stripes, pos = size[wide] // 32, at[wide]
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                for j in range(4):
                    acc[j][on] = _round(acc[j][on], u64[pos[on] + 32 * k + 8 * j])
            mixed = _rot(acc[0], 1) + _rot(acc[1], 7) + _rot(acc[2], 12) + _rot(acc[3], 18)
            for a in acc:
                mixed = (mixed ^ _round(np.uint64(0), a)) * P1 + P4
            h[wide] = mixed
            at = at.copy()
            at[wide] += 32 * stripes
        left = np.where(size < LONG_SPAN, size % 32, 0)
        h += size.astype(np.uint64)
        for k in range(3):
            on = np.flatnonzero(left >= 8 * (k + 1))
            if not len(on):
                break
            h[on] = _rot(h[on] ^ _round(np.uint64(0), u64[at[on]]), 27) * P1 + P4
            at[on] += 8
        left &= 7
        on = np.flatnonzero(left >= 4)
        h[on] = _rot(h[on] ^ (u32[at[on]].astype(np.uint64) * P1), 23) * P2 + P3
        at[on] += 4
        left &= 3
        for k in range(3):
            on = np.flatnonzero(left > k)
            h[on] = _rot(h[on] ^ (data[at[on]].astype(np.uint64) * P5), 11) * P1
            at[on] += 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= LONG_SPAN):
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), int(seed))
    return h
