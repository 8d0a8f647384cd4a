"""Token counts by rank-synchronous array merging.

For a ``tokenizers`` BPE file with word ends. Texts are cut at ASCII white
space, which no pre-token crosses; each distinct chunk of a batch is normalised
and split into byte-level pre-tokens. All distinct pre-tokens of a batch lie in
one ragged numpy array of symbols; in each round every sequence merges its
lowest-ranked adjacent pair, everywhere at once, until no sequence has a known
pair. The surviving symbols are counted and summed up to the texts.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakemart.llm.common import pick, slices, prepare, to_batch

#: Distinct chunks whose counts a task keeps between batches.
CACHE_CHUNKS = 400_000
LATIN_END = "\u0250"
_NONE = np.int64(1 << 40)


class Merger:
    """The merge table of a BPE file, as arrays that map a pair to its rank and
    its new symbol."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.end = model["end_of_word_suffix"]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.slots = 1 << 20
        self.multipliers = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
        # a few tables in a row: a pair that finds its slot taken goes to the next
        self.tables, rest = [], np.arange(len(keys))
        for m in self.multipliers:
            slot = self._slot(keys[rest], m)
            _, first = np.unique(slot, return_index=True)
            held = np.full(self.slots, -1, np.int32)
            held[slot[first]] = rest[first]
            self.tables.append(held)
            rest = np.delete(rest, first)
        if len(rest):
            raise ValueError("merge table does not fit")
        self.keys = np.append(keys, -1)
        self.made = np.append(made, -1)
        plain = self.byte_symbols()
        self.byte = np.array([vocab[c] for c in plain], np.int64)
        self.last_byte = np.array([vocab[c + self.end] for c in plain], np.int64)

    @staticmethod
    def byte_symbols() -> list[str]:
        """The character that stands for each byte: itself if it prints, else one
        of the characters from 256 on, in byte order."""
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shifted = (b for b in range(256) if b not in set(prints))
        other = {b: chr(256 + i) for i, b in enumerate(shifted)}
        return [other.get(b, chr(b)) for b in range(256)]

    def _slot(self, keys: np.ndarray, multiplier: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(multiplier)) >> np.uint64(44)).astype(np.int64)

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        """Rank of each pair key, or ``_NONE``."""
        out = np.full(len(pairs), _NONE, np.int64)
        rest = np.arange(len(pairs))
        for m, held in zip(self.multipliers, self.tables, strict=True):
            at = held[self._slot(pairs[rest], m)]
            hit = self.keys[at] == pairs[rest]
            out[rest[hit]] = at[hit]
            rest = rest[~hit & (at >= 0)]
            if not len(rest):
                break
        return out

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each non-empty byte string after all merges."""
        result = np.zeros(len(pieces), np.int64)
        for a in range(0, len(pieces), 20_000):
            result[a : a + 20_000] = self._counts(pieces[a : a + 20_000])
        return result

    def _counts(self, pieces: list[bytes]) -> np.ndarray:
        size = np.array([len(p) for p in pieces], np.int64)
        result = size.copy()
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self.byte[raw]
        ends = np.cumsum(size) - 1
        symbols[ends] = self.last_byte[raw[ends]]
        owner = np.repeat(np.arange(len(pieces)), size)
        while len(symbols) > 1:
            ranks = self.ranks(symbols[:-1] * self.size + symbols[1:])
            ranks[owner[:-1] != owner[1:]] = _NONE
            ranks = np.append(ranks, _NONE)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(ranks, starts)
            size = np.diff(np.append(starts, len(owner)))
            best = np.repeat(least, size)
            merge = (ranks == best) & (ranks != _NONE)
            # a run of one symbol can only merge every other pair, from the left
            run = np.flatnonzero(merge[1:] & merge[:-1]) + 1
            for i in run:
                if merge[i - 1]:
                    merge[i] = False
            at = np.flatnonzero(merge)
            symbols[at] = self.made[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            keep &= np.repeat(least != _NONE, size)  # done sequences leave
            np.subtract.at(result, owner[at], 1)
            symbols, owner = symbols[keep], owner[keep]
        return result


class Counter:
    """Token counts of whole texts, as the library gives them without added
    special tokens; special strings inside a text are one token each."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merger = Merger(spec)
        # The file's pre-token pattern and special strings.
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)))
        self.library = Tokenizer.from_file(path)
        self.byte_of = {c: b for b, c in enumerate(self.merger.byte_symbols())}
        self.cache: dict[bytes, int] = {}

    def split(self, text: str) -> list[bytes]:
        """Normalise (NFC, lower case) and split. Texts with characters past the
        Latin blocks take the library's own normaliser and splitter, whose
        Unicode tables may be of another version than Python's."""
        if text.isascii() or max(text) < LATIN_END:
            return [p.encode() for p in self.pattern.findall(unicodedata.normalize("NFC", text).lower())]
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in pieces]

    def pre_tokens(self, chunk: bytes) -> tuple[list[bytes], int]:
        """Byte pre-tokens of a chunk and the number of special strings in it."""
        text = chunk.decode("utf-8", "replace")
        specials = 0
        parts = [text]
        if "<|" in text:
            parts = self.special.split(text)
            specials = len(parts) - 1
        return [p for part in parts if part for p in self.split(part)], specials

    def learn(self, chunks: list[bytes]) -> None:
        """Count the tokens of chunks that are not in the cache."""
        index: dict[bytes, int] = {}
        owner: list[int] = []
        of: list[int] = []
        base = np.zeros(len(chunks), np.int64)
        for i, chunk in enumerate(chunks):
            pieces, base[i] = self.pre_tokens(chunk)
            for p in pieces:
                owner.append(i)
                of.append(index.setdefault(p, len(index)))
        if of:
            counts = self.merger.counts(list(index))
            base += np.bincount(owner, weights=counts[of], minlength=len(chunks)).astype(np.int64)
        self.cache.update(zip(chunks, base.tolist(), strict=True))

    def count(self, texts: list[bytes]) -> list[int]:
        if len(self.cache) > CACHE_CHUNKS:
            self.cache.clear()
        split = [t.split() for t in texts]
        new = set().union(*split).difference(self.cache) if split else set()
        if new:
            self.learn(list(new))
        get = self.cache.__getitem__
        return [sum(map(get, chunks)) for chunks in split]


def count_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row, from its whole text.

    ``tokenizer`` is the path of the vocabulary file on every machine. A null
    text is empty (no bytes, no tokens); repeated rows each get their row; a
    null id is passed through. Map-side only: a task holds a slice of texts
    and a bounded cache."""
    prepare(docs.sparkSession)
    source = pick(docs, doc_id=doc_id, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch, column in slices(batches):
            texts = column.to_pylist()
            n = np.array(counter.count(texts), np.int64)
            size = np.array([len(t) for t in texts], np.int64)
            yield to_batch(doc_id=batch.column(0), n_bytes=size, n_tokens=n, over_limit=n > limit)

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    return count_tokens(docs, tokenizer).select("doc_id", "n_bytes", "n_tokens", F.col("over_limit"))
