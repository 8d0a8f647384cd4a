"""Fill-in-the-middle transformation.

A text is cut into units (code points, words or lines). Its bytes are taken in
blocks of fixed size; a Fenwick tree over the blocks stores how many units and
how many code points begin in each. A cut after k units is found by a
binary-lifting descent of the tree, which gives the block and the counts before
it, and then locally within that block. The trees of all texts of a slice are
laid side by side, so a descent takes all of them down together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import buffers, pick, prepare, slices, to_batch
from lakemart.llm.words import NOT_SPACE

#: Bytes of a block.
BLOCK = 1024

# The marks before the parts, and the shares (in 100) of plain and of suffix-first texts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20


def code_point_starts(raw: np.ndarray) -> np.ndarray:
    """Which bytes begin a code point of UTF-8."""
    return (raw & 0xC0) != 0x80


def _after(raw: np.ndarray, offsets: np.ndarray, begins_before: np.ndarray) -> np.ndarray:
    """Which bytes follow a byte of ``begins_before`` in their text; a text's first byte always does."""
    out = np.zeros(len(raw), bool)
    out[1:] = begins_before[:-1]
    out[offsets[:-1][np.diff(offsets) > 0]] = True
    return out


def unit_starts(raw: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """Which bytes begin a unit. A word goes with the white space after it, a line
    with its line feed; white space before the first word is a unit."""
    if unit == "code_point":
        return code_point_starts(raw)
    if unit == "word":
        inside = NOT_SPACE[raw]
        out = inside & _after(raw, offsets, ~inside)
        out[offsets[:-1][np.diff(offsets) > 0]] = True
        return out
    if unit == "line":
        return _after(raw, offsets, raw == 0x0A)
    raise ValueError(f"no such unit: {unit}")


@dataclass
class Forest:
    """A Fenwick tree of unit and code-point counts for each text of a slice.

    ``tree[base[t] + i - 1]`` holds the counts of the blocks i - lowbit(i) .. i - 1 of text t."""

    starts: np.ndarray  # per byte: a unit begins
    points: np.ndarray  # per byte: a code point begins
    offsets: np.ndarray  # of the texts, n + 1
    base: np.ndarray  # of the texts' trees, n + 1
    tree: np.ndarray  # (blocks, 2)
    totals: np.ndarray  # (texts, 2)

    def find(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text, the byte (from its beginning) after its first k[t]
        units, and the code points before it; k[t] is at most its units."""
        size = np.diff(self.base)
        at = np.zeros(len(k), np.int64)
        before = np.zeros((len(k), 2), np.int64)
        step = 1 << max(int(size.max(initial=0)).bit_length() - 1, 0)
        while step:
            up = at + step
            node = self.tree[np.minimum(self.base[:-1] + up - 1, len(self.tree) - 1)] if len(self.tree) else before
            # whole blocks in which no more than k units begin lie before the cut
            go = (up <= size) & (before[:, 0] + node[:, 0] <= k)
            at[go] = up[go]
            before[go] += node[go]
            step >>= 1
        place = np.diff(self.offsets)
        points = self.totals[:, 1].copy()
        for t in np.flatnonzero(at < size):
            lo = self.offsets[t] + at[t] * BLOCK
            block = slice(lo, min(lo + BLOCK, self.offsets[t + 1]))
            local = int(np.flatnonzero(self.starts[block])[k[t] - before[t, 0]])
            place[t] = at[t] * BLOCK + local
            points[t] = before[t, 1] + np.count_nonzero(self.points[block][:local])
        return place, points


def grow(raw: np.ndarray, offsets: np.ndarray, unit: str = "code_point") -> Forest:
    """The trees over the texts ``raw[offsets[t]:offsets[t + 1]]``."""
    starts, points = unit_starts(raw, offsets, unit), code_point_starts(raw)
    size = (np.diff(offsets) + BLOCK - 1) // BLOCK
    base = np.append(0, np.cumsum(size))
    text = np.repeat(np.arange(len(size)), size)
    nth = np.arange(base[-1]) - base[text]
    edges = offsets[text] + nth * BLOCK
    if len(edges):
        counts = np.stack([np.add.reduceat(x, edges, dtype=np.int64) for x in (starts, points)], axis=1)
    else:
        counts = np.zeros((0, 2), np.int64)
    upto = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(counts, axis=0)])
    low = (nth + 1) & -(nth + 1)
    here = np.arange(1, base[-1] + 1)
    return Forest(starts, points, offsets, base, upto[here] - upto[here - low], upto[base[1:]] - upto[base[:-1]])


def split(raw: np.ndarray, offsets: np.ndarray, cut1: np.ndarray, cut2: np.ndarray, unit: str = "code_point") -> dict[str, np.ndarray]:
    """For each text its number of units ``n``, and with a = min, b = max of
    cut1 % (n + 1) and cut2 % (n + 1): the bytes ``prefix_end`` and ``middle_end``
    after a and b units, and the code points before them."""
    forest = grow(raw, offsets, unit)
    n = forest.totals[:, 0]
    a, b = cut1 % (n + 1), cut2 % (n + 1)
    prefix_end, prefix_points = forest.find(np.minimum(a, b))
    middle_end, upto = forest.find(np.maximum(a, b))
    return {"n": n, "prefix_end": prefix_end, "middle_end": middle_end, "prefix_chars": prefix_points, "middle_chars": upto - prefix_points}


def join_parts(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    """The transformed text of one form."""
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    if form == "spm":
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return prefix + middle + suffix


def restore(form: str, output: bytes) -> bytes:
    """The text that ``output`` was made of. A text with a mark of its own is
    always plain, so the first mark of each kind is the one put in."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    at_second = output.index(second, len(first))
    at_middle = output.index(MIDDLE, at_second + len(second))
    one, two = output[len(first) : at_second], output[at_second + len(second) : at_middle]
    middle = output[at_middle + len(MIDDLE) :]
    return b"".join((one, middle, two) if form == "psm" else (two, middle, one))


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of ``seed:doc_id`` (a null id is empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "code_point", seed: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (units), form (plain, psm, spm),
    prefix_chars and middle_chars (code points; null if plain), output (the
    transformed text) and restored (the text rebuilt from output and form).

    Cuts and form depend on the id and ``seed`` only, so rows of one id, null
    ids among them, share their draws. A null text is empty, and an empty text
    is plain. ``unit`` is ``code_point``, ``word`` or ``line``. Every text is
    cut whole; a task holds a slice of a few MB, or one longer text. Map-side only."""
    prepare(docs.sparkSession)
    source = pick(docs, doc_id=doc_id, text=text)
    source = source.select("doc_id", "text", *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id"), seed), 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches):
            raw, offsets = buffers(column)
            h1, h2, h3, h4 = (batch.column(2 + i).to_numpy() for i in range(4))
            parts = split(raw, offsets, h1, h2, unit)
            forms, outputs, restored = [], [], []
            texts = column.to_pylist()
            for t, whole in enumerate(texts):
                plain = not whole or h3[t] % 100 >= PLAIN_FROM or PREFIX in whole or SUFFIX in whole or MIDDLE in whole
                form = "plain" if plain else "spm" if h4[t] % 100 < SPM_BELOW else "psm"
                i, j = parts["prefix_end"][t], parts["middle_end"][t]
                forms.append(form)
                outputs.append(join_parts(form, whole[:i], whole[i:j], whole[j:]))
                restored.append(restore(form, outputs[-1]))
            marked = pa.array([f != "plain" for f in forms], pa.bool_())
            yield to_batch(
                doc_id=batch.column(0),
                n=parts["n"],
                form=pa.array(forms, pa.string()),
                prefix_chars=_only(parts["prefix_chars"], marked),
                middle_chars=_only(parts["middle_chars"], marked),
                output=pa.array(outputs, pa.binary()).cast(pa.string()),
                restored=pa.array(restored, pa.binary()).cast(pa.string()),
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
    )


def _only(values: np.ndarray, on: pa.Array) -> pa.Array:
    return pc.if_else(on, pa.array(values, pa.int64()), pa.scalar(None, pa.int64()))


def op12_fill_in_middle(docs: DataFrame) -> DataFrame:
    """The contract's rows: digests in place of the two texts."""
    found = fill_in_middle(docs)
    digest = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digest)


#: The same rows in DuckDB SQL, cut by substring.
ORACLE_SQL = f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
numbers AS (
  SELECT doc_id, text, length(text) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM drawn),
cuts AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {PLAIN_FROM} THEN 'plain'
              WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
