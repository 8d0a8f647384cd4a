from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from lakemart.llm import merkle_manifest as M
from lakemart.llm.merkle_manifest import build_manifest, op13_merkle_manifest, verify
from tests.llm.conftest import DOCS_SCHEMA, documents


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    out = b""
    for v in row:
        out += b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode())
    return hashlib.sha256(out).hexdigest()


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root over ``nodes``, and for each node its siblings (before, after), level by level."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            lo = i - i % 16
            path.append(("".join(nodes[lo:i]), "".join(nodes[i + 1 : lo + 16])))
        at = [i // 16 for i in at]
        nodes = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows) -> list[tuple]:
    """The contract, source by source, all in memory."""
    by_source = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        changed = text
        if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            changed = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        by_source[source].append((doc_id, leaf((doc_id, source, lang, n_chars, text)), leaf((doc_id, source, lang, n_chars, changed))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = climb([r[1] for r in by_source[s]])
    if not order:
        return []
    root, tops = climb([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (doc_id, own, changed), path in zip(by_source[s], trees[s][1]):
            whole = path + top
            node = changed
            for before, after in whole:
                node = sha(before, node, after)
            proof = sha(*[b + a for b, a in whole])
            out.append((doc_id, own, trees[s][0], root, proof, node, node == root))
    return out


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def check(spark, df, rows):
    got = sorted((tuple(r) for r in op13_merkle_manifest(df).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_whole_table(spark, sf001):
    df = documents(spark, sf001)
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    check(spark, df, rows)


def test_sql_equals_brute_force(odd_rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    rows = [*odd_rows, *((100 + i, f"Text {i}", "en", "hot", i) for i in range(300))]
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(con.execute(M.ORACLE_SQL).fetchall(), key=key) == sorted(brute(rows), key=key)


def test_odd_rows(spark, odd_docs, odd_rows):
    check(spark, odd_docs, odd_rows)


def test_heights(spark):
    """Trees that end within, at and after a written level, beside a lone leaf."""
    rows = [(10_000 * n + i, f"Text {i}", "en", f"n{n}", i) for n in (1, 2, 16, 17, 256, 257, 4097) for i in range(n)]
    rows.append((0, "Alone", None, None, None))
    check(spark, spark.createDataFrame(rows, DOCS_SCHEMA).repartition(7), rows)


def test_one_source_of_one_row(spark):
    rows = [(5, "only", None, "s", 1)]
    df = spark.createDataFrame(rows, DOCS_SCHEMA)
    check(spark, df, rows)
    assert op13_merkle_manifest(df).first()["proof_sha256"] == sha()


def test_empty(spark, no_docs):
    assert op13_merkle_manifest(no_docs).collect() == []


def test_repeated_rows_and_ids(spark):
    rows = [(1, "same", "en", "s", 4)] * 300 + [(1, f"other {i}", "en", "s", 4) for i in range(40)] + [(None, "B", None, "s", 1)] * 20
    check(spark, spark.createDataFrame(rows, DOCS_SCHEMA).repartition(5), rows)


def test_a_change_anywhere_is_found(spark):
    rows = [(i, "text", "en", f"s{i % 3}", i) for i in range(700)]
    df = spark.createDataFrame(rows, DOCS_SCHEMA)
    manifest = build_manifest(df, {"n_chars": F.when(F.col("doc_id") == 411, F.lit(0)).otherwise(F.col("n_chars"))})
    bad = verify(manifest).where("not verified").select("doc_id").collect()
    assert [r["doc_id"] for r in bad] == [411]


def test_interior_levels_are_not_written(spark):
    rows = [(i, "t", "en", "s", i) for i in range(5000)]
    manifest = build_manifest(spark.createDataFrame(rows, DOCS_SCHEMA))
    counts = [level.count() for level in manifest.sources.levels]
    assert counts == [5000, 20, 1]  # levels 0, 2 and 4 of 5000, 313, 20, 2, 1
    assert M.SUBTREE == 256
