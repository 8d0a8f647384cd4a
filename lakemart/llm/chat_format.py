"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

Chat logs often hold a conversation several times, each snapshot with a few
more turns. The hash of a conversation's first k turns is taken for every k (a
running xor of turn hashes that hold their position). A conversation whose
whole hash is the k-turn prefix hash of a longer one is anti-joined away, as
are later copies of an equal one; the maximal ones are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import cut, discard, pick, ranked

#: Turns that are windowed, and rendered, together; a longer conversation is
#: hashed in two levels and rendered as several parts.
PART_TURNS = 256

# The marks around a rendered turn.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"


def _rank(turns: DataFrame) -> DataFrame:
    """Exact repeats dropped; ``pos`` is the place of a turn in its conversation
    (from 0, by turn, role, text; nulls first). Turns are range-sorted over all
    tasks and numbered there, so that no conversation is one task, however many
    of its turns share a number or have none."""
    rows = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).drop("copies")
    return ranked(rows, "conv_id", ["turn", "role", "text"], "pos", "ranked-turns")


def _turn_hash(seed: int) -> Column:
    """64 bits of a turn and its place; null role or text differ from empty ones."""
    return F.xxhash64(
        F.lit(seed), F.col("pos"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))
    )


def _prefixes(ranked: DataFrame) -> DataFrame:
    """conv_id, k, h1, h2: the 128-bit hash of the first k turns, for each k.
    Blocks of places are hashed apart and chained over their totals."""
    rows = ranked.select(
        "conv_id", F.floor(F.col("pos") / PART_TURNS).alias("block"), "pos", _turn_hash(1).alias("t1"), _turn_hash(2).alias("t2")
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "block").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    totals = totals.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"),
        *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(x) for x in ("x1", "x2")],
    )
    within = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.select("conv_id", "block", "pos", *[F.bit_xor(t).over(within).alias(t) for t in ("t1", "t2")])
    same = inner["conv_id"].eqNullSafe(totals["c"]) & (inner["block"] == totals["b"])
    return inner.join(totals, same).select(
        "conv_id", (F.col("pos") + 1).alias("k"), F.col("t1").bitwiseXOR(F.col("x1")).alias("h1"), F.col("t2").bitwiseXOR(F.col("x2")).alias("h2")
    )


def maximal_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ranked turns, and (conv_id, n_turns) of the conversations that are no
    proper prefix of another; of equal ones, the least conv_id (null last)."""
    placed = _rank(turns)
    prefixes = cut(_prefixes(placed), "prefixes")
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct("k", "h1", "h2")).alias("w")).select("conv_id", "w.*")
    least = F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")).alias("first")
    unique = whole.groupBy("k", "h1", "h2").agg(least).select("k", "h1", "h2", F.col("first.conv_id").alias("conv_id"))
    # prefixes that some conversation goes on after
    lengths = whole.select(F.col("conv_id").alias("c"), F.col("k").alias("n"))
    inner = prefixes.join(lengths, prefixes["conv_id"].eqNullSafe(lengths["c"])).where("k < n").select("k", "h1", "h2").distinct()
    kept = unique.join(inner, ["k", "h1", "h2"], "left_anti")
    maximal = cut(kept.select("conv_id", F.col("k").alias("n_turns")), "maximal")
    discard(prefixes)
    return placed, maximal


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, part, n_turns (of the conversation), first_turn, chat: the
    maximal conversations rendered with turn marks, in parts of ``PART_TURNS``
    turns (nearly always one part, 0; first_turn is the place of its first turn).

    Turns are ordered by turn, role, text (nulls first); exact repeats of a turn
    count once. A null role is rendered as ``unknown``, a null text as empty,
    but both differ from those in comparisons. Turns without a conv_id are
    taken as one conversation. An empty table gives no rows."""
    source = pick(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    placed, kept = maximal_conversations(source)
    kept = kept.select(F.col("conv_id").alias("c"), "n_turns")
    line = F.concat(
        F.lit(TURN_START), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(TURN_END)
    )
    lines = placed.join(kept, placed["conv_id"].eqNullSafe(kept["c"])).select(
        "conv_id", F.floor(F.col("pos") / PART_TURNS).alias("part"), "n_turns", "pos", line.alias("line")
    )
    parts = lines.groupBy("conv_id", "part", "n_turns").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    return parts.select(
        "conv_id", "part", "n_turns", F.col("lines")[0]["pos"].alias("first_turn"), F.array_join(F.col("lines")["line"], "").alias("chat")
    )


def op5_chat_format(conversations: DataFrame) -> DataFrame:
    return format_chats(conversations)


#: The same rows in DuckDB SQL: prefixes are compared turn by turn, without hashes.
ORACLE_SQL = f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
ranked AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos
  FROM turns),
whole AS (SELECT conv_id, count(*) AS n_turns FROM ranked GROUP BY conv_id),
shared AS (
  SELECT a.conv_id AS short_id, b.conv_id AS long_id, count(*) AS n
  FROM ranked a JOIN ranked b
    ON a.pos = b.pos AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text
   AND a.conv_id IS DISTINCT FROM b.conv_id
  GROUP BY 1, 2),
covered AS (
  SELECT DISTINCT s.short_id AS conv_id
  FROM shared s JOIN whole a ON a.conv_id = s.short_id JOIN whole b ON b.conv_id = s.long_id
  WHERE s.n = a.n_turns AND (b.n_turns > a.n_turns OR (b.n_turns = a.n_turns AND b.conv_id < a.conv_id)))
SELECT r.conv_id, CAST(floor(r.pos / {PART_TURNS}) AS BIGINT) AS part, w.n_turns, min(r.pos) AS first_turn,
       string_agg('{TURN_START}' || coalesce(r.role, 'unknown') || chr(10) || coalesce(r.text, '') || '<|im_end|>' || chr(10), '' ORDER BY r.pos) AS chat
FROM ranked r JOIN whole w ON w.conv_id = r.conv_id
WHERE r.conv_id NOT IN (SELECT conv_id FROM covered)
GROUP BY 1, 2, 3
"""
