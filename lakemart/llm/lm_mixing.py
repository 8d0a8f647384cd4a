"""Logistic context mixing over bits, for batches of tokens at once.

``Mixer`` combines predictors' bit counts: the log-odds of each predictor are
weighted by a set of weights that a gate selects, an adaptive map of what came
true refines the sum, and learning is online. ``CodeModel`` predicts the hashed
code of a known token, ``SpellModel`` the bytes of a new one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

APM = 24
DELTA = 0.4
MOST_STEP = 0.3
CLOSE = b" "
#: Bits of a known token's code.
CODE_BITS = 18
#: Bytes that the orders of the spelling model look back on.
SPELL_ORDERS = 4


def log_odds(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.log((one + np.float32(DELTA)) / (zero + np.float32(DELTA)))


@dataclass
class Mixer:
    """Weights by gate and predictor; hits (ones, all) of the adaptive map by
    gate and step of the mixed log-odds; the curvature that a gate's steps so far had."""

    weights: np.ndarray
    hits: np.ndarray
    curve: np.ndarray

    @staticmethod
    def fresh(gates: int, predictors: int) -> Mixer:
        return Mixer(np.full((gates, predictors), 1.0 / predictors), np.zeros((2, gates * APM)), np.zeros(gates))

    def mix(self, stretch: list[np.ndarray], gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mixed log-odds and the adaptive map's cell."""
        w = self.weights.astype(np.float32)
        mixed = sum(w[:, k][gate] * s for k, s in enumerate(stretch))
        mixed = np.clip(mixed, -14, 14)
        return mixed, gate * APM + np.clip((mixed + 12) * (APM / 24), 0, APM - 1).astype(np.int64)

    def refined(self) -> np.ndarray:
        """The share of ones in each cell, drawn to the cell's middle where little was seen."""
        cells = self.hits.shape[1]
        middle = 1 / (1 + np.exp(-((np.arange(cells) % APM + 0.5) * (24 / APM) - 12)))
        return ((self.hits[0] + 16 * middle) / (self.hits[1] + 16)).astype(np.float32)

    def learn(self, stretch: list[np.ndarray], gate: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        """One online step for a batch of bits, each counted ``weight`` times."""
        mixed, cell = self.mix(stretch, gate)
        p = 1 / (1 + np.exp(-mixed))
        gates, cells = len(self.weights), self.hits.shape[1]
        self.hits[0] += np.bincount(cell, weights=weight * bit, minlength=cells)
        self.hits[1] += np.bincount(cell, weights=weight, minlength=cells)
        error = (weight * (bit - p)).astype(np.float32)
        square = sum(s * s for s in stretch)
        self.curve += np.bincount(gate, weights=weight * p * (1 - p) * square, minlength=gates)
        for k, s in enumerate(stretch):
            g = np.bincount(gate, weights=error * s, minlength=gates)
            self.weights[:, k] += np.clip(g / (self.curve + 1.0), -MOST_STEP, MOST_STEP)
        np.clip(self.weights, -1.0, 2.0, out=self.weights)

    def log2(self, refined: np.ndarray, stretch: list[np.ndarray], gate: np.ndarray, bit: np.ndarray) -> np.ndarray:
        mixed, cell = self.mix(stretch, gate)
        p = np.float32(0.5) / (1 + np.exp(-mixed)) + np.float32(0.5) * refined[cell]
        return np.log2(np.where(bit == 1, p, 1 - p))


class ContextCounts:
    """Counts of the bits of codes under the preceding token, from rows in the
    order of (context, code) that hold a context whole. ``large`` contexts
    (ascending) may be dealt by the first ``TOP_BITS`` bits of the code: the
    counts of those bits come from ``tops``, by context and first bits."""

    TOP_BITS = 9

    def __init__(self, large: np.ndarray, tops: np.ndarray):
        self.large, self.trees = large, tree_of(tops)

    def counts(self, ctx: np.ndarray, codes: np.ndarray, c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Zeros and ones seen at each row's node, for each bit of the codes."""
        at = np.searchsorted(self.large, ctx)
        split = np.flatnonzero(self.large[np.minimum(at, len(self.large) - 1)] == ctx) if len(self.large) else at[:0]
        at = at[split]
        fresh = np.ones(len(ctx), bool)
        fresh[1:] = ctx[1:] != ctx[:-1]
        for depth in range(CODE_BITS):
            node = codes >> (CODE_BITS - depth)
            starts = fresh.copy()
            starts[1:] |= node[1:] != node[:-1]
            first, group = np.flatnonzero(starts), np.cumsum(starts) - 1
            ones = np.add.reduceat(c * ((codes >> (CODE_BITS - 1 - depth)) & 1), first)
            one = ones[group].astype(np.float32)
            zero = (np.add.reduceat(c, first) - ones)[group].astype(np.float32)
            if depth < self.TOP_BITS and len(split):
                child = 2 * ((1 << depth) | node[split])
                zero[split], one[split] = self.trees[at, child], self.trees[at, child + 1]
            yield zero, one


def tree_of(leaves: np.ndarray) -> np.ndarray:
    """Counts of every node, tree by tree: node i has the children 2i and 2i + 1."""
    n = leaves.shape[1]
    tree = np.zeros((len(leaves), 2 * n), np.float32)
    for row, level in zip(tree, leaves, strict=True):
        level, at = level.astype(np.float64), n
        row[n:] = level
        while at > 1:
            level, at = level[0::2] + level[1::2], at // 2
            row[at : 2 * at] = level
    return tree


class CodeModel:
    """Bits of a token's code under four contexts: none (all texts), the text's
    class, the hashed end of the preceding token (for the first
    ``ContextCounts.TOP_BITS`` bits) and the preceding token. ``leaves`` has token
    counts by class and code, ``after_end`` by hashed end and first bits; the
    preceding token's come from ``ContextCounts``."""

    STEPS = (1, 10, 200)
    CONTEXT_STEPS = (1, 2, 3, 5, 8, 16, 60, 400, 5000)
    GATES, PREDICTORS = 10 * 4 * 6, 4

    def __init__(self, leaves: np.ndarray, after_end: np.ndarray):
        self.sizes = leaves.sum(axis=1)  # training tokens of each class
        self.counts = [leaves.astype(np.float32), after_end.astype(np.float32)]
        self._made: dict[bool, list[np.ndarray]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_made": {}}

    def odds(self, own: bool) -> list[np.ndarray]:
        """Log-odds of all texts, by class and by hashed end: of each node, or
        (``own``) of each child's node without one occurrence of the child."""
        if own not in self._made:
            self._made.clear()
            leaves, after_end = self.counts
            made = []
            for counts in (leaves.sum(axis=0, keepdims=True), leaves, after_end):
                out = np.empty((len(counts), (2 if own else 1) * counts.shape[1]), np.float32)
                for k in range(len(counts)):  # a tree at a time, to hold little beside the result
                    tree = tree_of(counts[k : k + 1])
                    out[k] = (_less_one(tree) if own else log_odds(tree[:, 0::2], tree[:, 1::2]))[0]
                made.append(out)
            self._made[own] = made
        return self._made[own]

    def bits(
        self, cls: np.ndarray, ends: np.ndarray, codes: np.ndarray, following: Iterator[tuple[np.ndarray, np.ndarray]], own: bool
    ) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        """Log-odds, gate and bit for each bit of the codes; ``following`` has the
        zeros and ones after the preceding token; ``own``: leave one occurrence out."""
        nothing = np.zeros(len(codes), np.float32)
        rows = [np.zeros_like(cls), cls, ends]
        tables = self.odds(own)
        flat = [t.reshape(-1) for t in tables]
        base = [r * t.shape[1] for r, t in zip(rows, tables, strict=True)]
        for depth, (zero, one) in enumerate(following):
            node = (1 << depth) | (codes >> (CODE_BITS - depth))
            bit = (codes >> (CODE_BITS - 1 - depth)) & 1
            if own:
                zero, one = np.maximum(zero - (bit == 0), 0).astype(np.float32), np.maximum(one - bit, 0).astype(np.float32)
                node = 2 * node + bit
            stretch = [log_odds(zero, one), flat[0][node], flat[1][base[1] + node]]
            stretch.append(flat[2][base[2] + node] if depth < ContextCounts.TOP_BITS else nothing)
            gate = _step(self.CONTEXT_STEPS, zero + one) * 24 + min(depth // 3, 5)
            gate += 6 * _step(self.STEPS, np.minimum(zero, one))  # how mixed the node is
            yield stretch, gate, bit


def _less_one(tree: np.ndarray) -> np.ndarray:
    """For each child (2 node + bit) of a tree, its node's log-odds when one occurrence of the child is left out."""
    zero, one = tree[:, 0::2], tree[:, 1::2]
    out = np.empty_like(tree)
    out[:, 0::2] = log_odds(np.maximum(zero - 1, 0), one)
    out[:, 1::2] = log_odds(zero, np.maximum(one - 1, 0))
    return out


@cache
def _step_table(steps: tuple[int, ...]) -> np.ndarray:
    return np.searchsorted(steps, np.arange(steps[-1] + 1), side="right")


def _step(steps: tuple[int, ...], n: np.ndarray) -> np.ndarray:
    """How many of ``steps`` each of ``n`` reaches."""
    return _step_table(steps)[np.minimum(n, steps[-1]).astype(np.int32)]


class SpellModel:
    """Bits of the bytes of a closed token under its last one, two (with the text's
    class), three and five bytes; ``tables`` count bits of distinct tokens, by slot. ``slot_bits`` sizes
    the tables of all orders but the first."""

    STEPS = (1, 2, 4, 12, 60, 400, 5000)
    GATES, PREDICTORS = 8 * 8, SPELL_ORDERS

    def __init__(self, slot_bits: int, tables: list[np.ndarray] | None = None):
        """``tables``: (2, slots) counts of zeros and ones by order."""
        self.sizes = [16] + [slot_bits] * (SPELL_ORDERS - 1)
        # small whole numbers while they are sent about
        if tables is None:
            self.tables = [np.zeros((1 << b, 2), np.uint16) for b in self.sizes]
        else:
            self.tables = [np.ascontiguousarray(np.minimum(t, 65535).astype(np.uint16).T) for t in tables]
        self._made: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_made": {}}

    def odds(self, own: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """Log-odds and step of each slot (``own``: of each slot and bit, with one such bit left out)."""
        if own not in self._made:
            self._made.clear()
            made = []
            for t in self.tables:
                odds = np.empty(len(t) * (2 if own else 1), np.float32)
                steps = np.empty(len(t), np.uint8)
                for lo in range(0, len(t), 1 << 16):  # a stretch at a time, to hold little beside the result
                    zero, one = (t[lo : lo + (1 << 16), k].astype(np.float32) for k in (0, 1))
                    if own:
                        less = np.stack([log_odds(np.maximum(zero - 1, 0), one), log_odds(zero, np.maximum(one - 1, 0))], axis=1)
                        odds[2 * lo : 2 * lo + less.size] = less.reshape(-1)
                    else:
                        odds[lo : lo + len(zero)] = log_odds(zero, one)
                    steps[lo : lo + len(zero)] = _step(self.STEPS, np.maximum(zero + one - own, 0))
                made.append((odds, steps))
            self._made[own] = made
        return self._made[own]

    @staticmethod
    def slot_bits(distinct: int) -> int:
        """Slots grow with the distinct tokens, between 2^18 and 2^21 (a broadcast of 25 MB)."""
        return min(max(int(distinct).bit_length() + 1, 18), 21)

    @staticmethod
    def spell(tokens: list[bytes], cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Bytes of the closed tokens, the token of each byte, and hashed contexts."""
        size = np.array([len(t) + 1 for t in tokens], np.int64)
        data = np.frombuffer(CLOSE.join(tokens) + CLOSE, np.uint8).astype(np.uint32)
        of = np.repeat(np.arange(len(tokens)), size)
        pos = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)

        def back(k: int) -> np.ndarray:
            out = np.zeros(len(data), np.uint32)
            out[k:] = data[:-k] + np.uint32(1)
            out[pos < k] = 0
            return out

        m1, m2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
        one = back(1)
        two = (one * m1 + back(2)) * m2
        three = (two + back(3)) * m1
        five = ((three + back(4)) * m2 + back(5)) * m1
        with_class = two + cls.astype(np.uint32)[of] * np.uint32(0xC2B2AE35)
        return data, of, [np.minimum(one, np.uint32(255)), with_class, three, five]

    def slots(self, context: np.ndarray, node: np.ndarray, order: int) -> np.ndarray:
        if order == 0:
            return (context << np.uint32(8)) | node
        h = (context ^ (node * np.uint32(0x27D4EB2F))) * np.uint32(0x9E3779B1)
        return (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - self.sizes[order])

    @staticmethod
    def byte_bits(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        node = np.ones(len(data), np.uint32)
        for k in range(7, -1, -1):
            bit = (data >> np.uint32(k)) & np.uint32(1)
            yield node, bit
            node = (node << np.uint32(1)) | bit

    def count(self, tokens: list[bytes], cls: np.ndarray, tables: list[np.ndarray]) -> None:
        """Add the bits of distinct tokens to (2, slots) ``tables``."""
        data, _, contexts = self.spell(tokens, cls)
        for node, bit in self.byte_bits(data):
            for order, context in enumerate(contexts):
                slots = self.slots(context, node, order).astype(np.int64) + bit.astype(np.int64) * (1 << self.sizes[order])
                np.add.at(tables[order].reshape(-1), slots, tables[order].dtype.type(1))  # of one type: else it is slow

    def bits(self, tokens: list[bytes], cls: np.ndarray, own: bool) -> tuple[np.ndarray, Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]]:
        data, of, contexts = self.spell(tokens, cls)

        made = self.odds(own)

        def each() -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
            for node, bit in self.byte_bits(data):
                stretch, gate = [], 0
                for order, context in enumerate(contexts):
                    slot = self.slots(context, node, order)
                    odds, step = made[order]
                    stretch.append(odds[slot * np.uint32(2) + bit if own else slot])
                    if order >= 2:
                        gate = gate * 8 + step[slot].astype(np.int64)
                yield stretch, gate, bit

        return of, each()
