import random

import duckdb

from lakemart.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    low = lambda x: (x is not None, x)  # noqa: E731  nulls first
    for conv, turn, role, text in set(rows):
        convs.setdefault(conv, []).append((low(turn), low(role), low(text)))
    said = {c: [(r[1], t[1]) for _, r, t in sorted(ts)] for c, ts in convs.items()}
    last = lambda c: (c is None, c or 0)
    out = {}
    for c, ts in said.items():
        covered = any(d != c and o[: len(ts)] == ts and (len(o) > len(ts) or last(d) < last(c)) for d, o in said.items())
        if not covered:
            out[c] = (len(ts), "".join(f"<|im_start|>{'unknown' if r is None else r}\n{t or ''}<|im_end|>\n" for r, t in ts))
    return out


def check(found, rows):
    got = {}
    for r in sorted(found, key=lambda r: r["part"]):
        n, text = got.get(r["conv_id"], (r["n_turns"], ""))
        got[r["conv_id"]] = (n, text + r["chat"])
    assert got == brute(rows)


def random_rows(rng):
    rows = []
    base = [[(rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "", None])) for _ in range(8)] for _ in range(3)]
    for conv in range(40):
        said = [*rng.choice(base)[: rng.randint(1, 8)], *([("user", "more")] if rng.random() < 0.2 else [])]
        rows += [(conv, 3 * t if conv % 2 else t, r, x) for t, (r, x) in enumerate(said)]
    return rows


def test_equals_brute_force(spark):
    for seed in range(3):
        rows = random_rows(random.Random(seed))
        rows += rows[:5] + [(None, 0, "user", "hi"), (None, None, None, None), (77, None, "user", "x"), (77, None, "user", "x"), (78, 1, None, None)]
        check(C.format_chats(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_a_conversation_over_several_parts(spark):
    n = 2 * C.PART_TURNS + 9
    rows = [(1, t, "user", f"t{t}") for t in range(n)] + [(2, t, "user", f"t{t}") for t in range(n - 1)]
    rows += [(3, t, "user", f"t{t}") for t in range(C.PART_TURNS)] + [(4, t, "user", f"t{t}" if t != 300 else "other") for t in range(301)]
    found = C.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    check(found, rows)
    assert sorted(r["part"] for r in found if r["conv_id"] == 1) == [0, 1, 2]


def test_equals_sql(spark, sf001):
    df = spark.read.parquet(f"{sf001}/conversations.parquet")
    got = sorted(map(tuple, C.op5_chat_format(df).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf001}/conversations.parquet')")
    assert got == sorted(con.execute(C.ORACLE_SQL).fetchall())


def test_native_empty_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    empty = spark.createDataFrame([], SCHEMA)
    assert C.format_chats(empty).count() == 0
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit(9)).withColumn("k", F.lit(1)).withColumn("block", F.lit(2))
    found = C.format_chats(df)
    check(found.collect(), rows)
    assert "Python" not in found._jdf.queryExecution().toString()


def test_a_hot_conversation_with_few_turn_numbers_is_many_tasks(spark):
    """A third of all rows without a conversation, in eight turn numbers or none."""
    from pyspark.sql import functions as F

    hot = [(None, i % 9 if i % 9 < 8 else None, "user", f"text {i}") for i in range(3000)]
    rows = hot + [(i // 4, i % 4, "user", f"t{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    # the last two: a written file is read by a task of its own
    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = [spark.conf.get(k, None) for k in keys]
    try:
        for k, v in zip(keys, ("false", "12", str(1 << 30), "100")):
            spark.conf.set(k, v)
        placed = C._rank(df)
        sizes = placed.where("conv_id is null").groupBy(F.spark_partition_id()).count().collect()
        found = C.format_chats(df).collect()
    finally:
        for k, v in zip(keys, old):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 2000
    check(found, rows)
