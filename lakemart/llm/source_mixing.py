"""Mixing sources to target weights by a time-varying curriculum, in DataFrame
functions only.

Every source has a weight schedule over training time 0 to 1. Its integral is
the source's weight; weights share the training budget, no source beyond a
number of passes over its own words. The words a source has given up to a time
are its target times the integral of its schedule up to then (cumulative
demand); a document's take that begins at some cumulative word is placed at the
time found by inverting that demand. Takes are then range-sorted by position.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import cut, ranked

#: A schedule: (time, weight) points from time 0 to 1, weights linear in between.
Schedule = tuple[tuple[float, float], ...]
#: Dealt to the sources in order, again and again. Their integrals, the sources'
#: weights, are 5 (falling), 2 (level) and 1 (late).
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 7.0), (1.0, 3.0)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.5), (0.5, 0.5), (1.0, 2.5)),
)
#: Words of the whole mix, as a share of all words; most passes over one source.
BUDGET = 1.5
MAX_PASSES = 2
#: Distinct documents of a source whose words are added up in one window, on average.
LEAF_ROWS = 1024
#: Equal rows that are told apart in one step.
COPIES_BLOCK = 65536
#: Most rounds of resharing; each caps a source at least.
MOST_ROUNDS = 10_000

_SPACE = "\\x20\\x09-\\x0D"
_SPACES = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """The number of words `[^\\x20\\x09-\\x0D]+` of a text (null: 0). Each word with
    the white space after it is turned into one character; no list of words is made."""
    marks = F.regexp_replace(F.ltrim(text, F.lit(_SPACES)), f"[^{_SPACE}]++[{_SPACE}]*+", "x")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def integral(schedule: Schedule) -> float:
    return sum((t2 - t1) * (w1 + w2) / 2 for (t1, w1), (t2, w2) in zip(schedule, schedule[1:]))


def time_of(schedule: Schedule, share: Column) -> Column:
    """The time by which the schedule's integral has reached ``share`` (0 to 1)
    of its whole: within a linear piece, the root of a quadratic."""
    whole = integral(schedule)
    y = share * F.lit(whole)
    pieces, upto = [], 0.0
    for (t1, w1), (t2, w2) in zip(schedule, schedule[1:]):
        slope = (w2 - w1) / (t2 - t1)
        inside = y - F.lit(upto)
        root = F.sqrt(F.greatest(F.lit(w1 * w1) + F.lit(2.0 * slope) * inside, F.lit(0.0)))
        here = F.lit(t1) + F.when(inside > 0, F.lit(2.0) * inside / (F.lit(w1) + root)).otherwise(F.lit(0.0))
        upto += (t2 - t1) * (w1 + w2) / 2
        pieces.append((upto, F.least(here, F.lit(t2))))
    out = pieces[-1][1]
    for end, here in reversed(pieces[:-1]):
        out = F.when(y < F.lit(end), here).otherwise(out)
    return out


def _source_key(source: Column) -> Column:
    """Never null; ordered as the sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _row_keys(columns: Sequence[str]) -> list[Column]:
    """128 bits of a whole row, as two texts in hex digits; ``_k1`` also orders the rows of a source."""
    each = [F.coalesce(F.concat(F.octet_length(F.col(f"`{c}`").cast("string")).cast("string"), F.lit(":"), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns]
    digest = F.md5(F.concat(*each).cast("binary"))
    return [F.substring(digest, 1, 16).alias("_k1"), F.substring(digest, 17, 16).alias("_k2")]


def share_targets(sources: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, budget: float = BUDGET, max_passes: int = MAX_PASSES) -> DataFrame:
    """s, source_size -> s, source_size, nth (place among the sources by ``s``),
    target: the sources' schedules' integrals share ``budget`` times all words;
    a target stops at ``max_passes`` times its source's size and the excess is
    shared again, until none is above.

    Only sums over sources reach the driver, three numbers a round."""
    weight = F.lit(integral(schedules[-1]))
    for i, schedule in enumerate(schedules[:-1]):
        weight = F.when(F.pmod("nth", F.lit(len(schedules))) == i, F.lit(integral(schedule))).otherwise(weight)
    numbered = ranked(sources.withColumn("g", F.lit(0)), "g", ["s"], "nth", "sources").drop("g")
    most = (F.lit(float(max_passes)) * F.col("source_size")).alias("most")
    held = cut(numbered.select("*", weight.alias("weight")).select("*", most), "source-weights")
    total = float(held.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    rate = 0.0  # words a unit of weight
    for _ in range(MOST_ROUNDS):
        full = F.col("most") <= F.lit(rate) * F.col("weight")
        capped, free = held.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            break
        before, rate = rate, (budget * total - (capped or 0.0)) / free
        if rate <= before:
            break
    return held.select("s", "source_size", "nth", F.least("most", F.lit(rate) * F.col("weight")).alias("target"))


def _before(sums: DataFrame, bits: int) -> DataFrame:
    """s, leaf, words -> s, leaf, start: the words of the source's leaves before
    this one. Added up in two levels, each over the square root of all leaves."""
    sums = sums.select("*", F.shiftright("leaf", bits // 2).alias("high"))
    upto = Window.partitionBy("s").orderBy("high").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.groupBy("s", "high").agg(F.sum("words").alias("words"))
    blocks = blocks.select("s", "high", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("outer"))
    within = Window.partitionBy("s", "high").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    inner = sums.select("s", "high", "leaf", F.coalesce(F.sum("words").over(within), F.lit(0)).alias("inner"))
    return inner.join(blocks, ["s", "high"]).select("s", "leaf", (F.col("outer") + F.col("inner")).alias("start"))


def placements(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    budget: float = BUDGET,
    max_passes: int = MAX_PASSES,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (words), source_size, target,
    passes (times the mix takes it), taken (size * passes), positions (training
    times, one a pass), and ``_k1``, ``_k2``: a hash of ``columns`` (the three
    named ones, if not given), equal for equal rows only.

    A source's documents are ordered by ``_k1``, the same on every run. The
    source gives its documents in that order, again and again; a take belongs to
    the mix if its middle word lies below the source's target, so a source's
    words differ from its target by half a document at most. The word-less take
    no words but have their places. Equal rows follow each other.

    A null text has no words; a null source is a source, the last. Repeated rows
    each get a row. An empty table gives no rows. Rows are combined before they
    are shuffled, and a source's words are added up in leaves of about
    ``LEAF_ROWS`` rows, so that a source with a third of all rows is many tasks."""
    keys = _row_keys(columns or [doc_id, source, text])
    named = [F.col(f"`{c}`").alias(name) for name, c in (("doc_id", doc_id), ("text", text), ("source", source))]
    rows = docs.select(*named, *keys)
    rows = rows.select(_source_key(F.col("source")).alias("s"), "_k1", "_k2", "doc_id", word_count(F.col("text")).alias("size"))
    counted = cut(rows.groupBy("s", "_k1", "_k2", "doc_id", "size").agg(F.count("*").alias("copies")), "sizes")
    words = (F.col("size") * F.col("copies")).alias("words")
    sources = cut(share_targets(counted.groupBy("s").agg(F.sum(words).alias("source_size")), schedules, budget, max_passes), "targets")

    bits = max(0, math.ceil(math.log2(max(1, counted.count()) / LEAF_ROWS)))
    leaf = F.shiftright(F.conv(F.substring("_k1", 1, 10), 16, 10).cast("long"), 40 - bits).alias("leaf")
    leaves = counted.select("*", leaf, words)
    starts = _before(leaves.groupBy("s", "leaf").agg(F.sum("words").alias("words")), bits).join(sources, "s")
    order = Window.partitionBy("s", "leaf").orderBy("_k1", "_k2", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = leaves.select("*", F.coalesce(F.sum("words").over(order), F.lit(0)).alias("inside"))
    placed = inside.join(starts, ["s", "leaf"])

    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_BLOCK).cast("long"))).alias("block")
    last = F.least(F.col("copies") - 1, F.col("block") + (COPIES_BLOCK - 1))
    each = placed.select("*", block).select("*", F.explode(F.sequence(F.col("block"), last)).alias("nth_copy"))
    at = (F.col("start") + F.col("inside") + F.col("nth_copy") * F.col("size")).alias("at")
    # twice the words before the middle of pass p, so that numbers stay whole
    middles = [F.lit(2 * p) * F.col("source_size") + F.lit(2) * F.col("at") + F.col("size") for p in range(max_passes)]
    taken = [m < F.lit(2.0) * F.col("target") for m in middles]
    positions = F.array(*[F.when(t, _time(schedules, m / F.nullif(F.lit(2.0) * F.col("target"), F.lit(0.0)))) for t, m in zip(taken, middles, strict=True)])
    out = each.select("*", at).select(
        "doc_id", "size", "source_size", "target", sum(t.cast("int") for t in taken).alias("passes"),
        F.filter(positions, lambda x: x.isNotNull()).alias("positions"), "_k1", "_k2", "s",
    )
    return out.select("doc_id", "size", "source_size", "target", "passes", (F.col("size") * F.col("passes")).alias("taken"), "positions", "_k1", "_k2", "s")


def _time(schedules: Sequence[Schedule], share: Column) -> Column:
    out = time_of(schedules[-1], share)
    for i, schedule in enumerate(schedules[:-1]):
        out = F.when(F.pmod("nth", F.lit(len(schedules))) == i, time_of(schedule, share)).otherwise(out)
    return out


def mix(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, budget: float = BUDGET, max_passes: int = MAX_PASSES, **names: str) -> DataFrame:
    """The training stream: the rows of ``docs`` with all their columns, once for
    each take, with ``mix_position``, range-sorted by it (equal positions by
    source and row hash).

    Equal rows are joined once and take all their places. All columns must have
    a text form (``cast`` to string); ``docs`` has no column ``mix_position``."""
    columns = docs.columns
    places = placements(docs, schedules, budget, max_passes, columns=columns, **names)
    takes = places.select(F.col("_k1").alias("_p1"), F.col("_k2").alias("_p2"), "s", F.explode("positions").alias("mix_position"))
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    once = docs.select(whole.alias("_row"), *_row_keys(columns)).groupBy("_k1", "_k2").agg(F.first("_row").alias("_row"))
    stream = once.join(takes, (F.col("_k1") == F.col("_p1")) & (F.col("_k2") == F.col("_p2")))
    stream = cut(stream.select("_row", "mix_position", "s", "_k1", "_k2"), "takes")
    order = ["mix_position", "s", "_k1", "_k2"]
    ordered = stream.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("_row.*", "mix_position")


def op11_source_mixing(docs: DataFrame) -> DataFrame:
    """The contract's rows with ``position``, the time of a document's first take
    (null if it has none), range-sorted by it."""
    rows = placements(docs).select(
        "doc_id", "size", "source_size", "target", "taken", F.try_element_at("positions", F.lit(1)).alias("position"), "s", "_k1", "_k2"
    )
    order = [F.col("position").asc_nulls_last(), "s", "_k1", "_k2"]
    held = cut(rows, "placements")
    return held.repartitionByRange(*order).sortWithinPartitions(*order).drop("s", "_k1", "_k2")


def _sql_time(schedule: Schedule, share: str) -> str:
    whole, upto, pieces = integral(schedule), 0.0, []
    for (t1, w1), (t2, w2) in zip(schedule, schedule[1:]):
        inside = f"({share} * {whole!r}::DOUBLE - {upto!r}::DOUBLE)"
        root = f"sqrt(greatest({w1 * w1!r}::DOUBLE + {2.0 * (w2 - w1) / (t2 - t1)!r}::DOUBLE * {inside}, 0.0::DOUBLE))"
        here = f"least({t1!r}::DOUBLE + CASE WHEN {inside} > 0 THEN 2.0::DOUBLE * {inside} / ({w1!r}::DOUBLE + {root}) ELSE 0.0::DOUBLE END, {t2!r}::DOUBLE)"
        upto += (t2 - t1) * (w1 + w2) / 2
        pieces.append((upto, here))
    out = pieces[-1][1]
    for end, here in reversed(pieces[:-1]):
        out = f"CASE WHEN {share} * {whole!r}::DOUBLE < {end!r}::DOUBLE THEN {here} ELSE {out} END"
    return out


def _by_schedule(values: Sequence[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE nth % {len(values)} {cases} END"


#: The same rows in DuckDB SQL: targets in closed form (sources by the rate at which they are full).
ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
             || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(text) || ':' || text, '-')) AS k
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM sized GROUP BY source),
weighted AS (SELECT *, {_by_schedule([f"{integral(s)!r}::DOUBLE" for s in SCHEDULES])} AS weight, {float(MAX_PASSES)!r}::DOUBLE * source_size AS most FROM sources),
rates AS (
  SELECT *, ({BUDGET!r}::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER upto, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER upto, 0)) AS rate
  FROM weighted WINDOW upto AS (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max(rate) AS rate FROM rates),
targets AS (
  SELECT r.source, r.source_size, r.nth, least(r.most, l.rate * r.weight) AS target FROM rates r, level l),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.nth,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
middles AS (SELECT *, CAST(2 * start + size AS DOUBLE) AS middle FROM placed),
shared AS (SELECT *, middle / (2.0::DOUBLE * target) AS share FROM middles)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (CAST(middle < 2.0::DOUBLE * target AS INT) + CAST(middle + 2 * source_size < 2.0::DOUBLE * target AS INT)) AS BIGINT) AS taken,
       CASE WHEN middle < 2.0::DOUBLE * target THEN {_by_schedule([_sql_time(s, "share") for s in SCHEDULES])} END AS position
FROM shared
"""
