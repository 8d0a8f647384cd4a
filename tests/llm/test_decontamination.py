import hashlib
import random
import re

from lakemart.llm import decontamination as D

from .conftest import documents

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items):
    windows = {}
    for item, text in items:
        ws = words(text)
        n = min(len(ws), 10)
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add("null" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(ws) - n + 1):
                if (ids := windows.get(tuple(ws[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(ws), len(hit), len(found), digest, bool(hit)))
    return out


def same(found, want):
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_equals_brute_force_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert any(w[-1] for w in want)
    same(D.op3_decontamination(docs, bench).collect(), want)


def test_equals_brute_force_on_few_words(spark):
    """Few different words: many partial, overlapping and short matches."""
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 7, 9, 10, 12, 30]) + 0)) for i in range(1, 9)][2:] + [(None, text(11)), (90, None), (91, "..."), (92, "a a a a a b b b b b a a")]
    docs = [(i, text(rng.choice([0, 2, 9, 10, 40, 300]))) for i in range(60)] + [(5, text(30)), (None, text(30)), (None, None), (7, "a b"), (7, "a b")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    same(D.op3_decontamination(df, bench).collect(), brute(docs, items))


def test_odd_rows_and_empty_tables(spark, odd_docs, odd_rows, no_docs):
    bench = spark.createDataFrame([(1, "the quick brown fox"), (2, "a b")], "item_id long, text string")
    plain = [(r[0], r[1]) for r in odd_rows]
    same(D.op3_decontamination(odd_docs, bench).collect(), brute(plain, [(1, "the quick brown fox"), (2, "a b")]))
    none = bench.limit(0)
    same(D.op3_decontamination(odd_docs, none).collect(), brute(plain, []))
    assert D.op3_decontamination(no_docs, bench).count() == 0
    kept = D.drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len(odd_rows) - sum(w[-1] for w in brute(plain, [(1, "the quick brown fox"), (2, "a b")]))
