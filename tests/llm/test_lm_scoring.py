import math
import zlib
from collections import Counter

import pytest

from lakemart.llm import lm_scoring as S

from .conftest import documents


def brute(rows):
    """Token count, known tokens, training tokens and base score by the definition."""
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    count = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(count.values()), len(count)
    base = [sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws) for ws in tokens]
    return [(h, len(ws), sum(count[w] > 0 for w in ws), n, b) for h, ws, b in zip(held, tokens, base)]


def check(found, rows):
    want = sorted(zip([(i is None, i) for i, _ in rows], brute(rows)), key=repr)
    got = sorted((((r["doc_id"] is None, r["doc_id"]), tuple(r[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens", "base_score"))) for r in found), key=repr)
    for (wi, w), (gi, g) in zip(want, got, strict=True):
        assert wi == gi and w[:4] == g[:4]
        assert g[4] == pytest.approx(w[4], rel=1e-9)


def test_base_equals_brute_force_and_the_model_beats_it(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    found = S.op2_lm_scoring(docs).collect()
    check(found, [(r["doc_id"], r["text"]) for r in docs.collect()])
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in found)


def test_odd_rows(spark, odd_docs, odd_rows):
    check(S.op2_lm_scoring(odd_docs).collect(), [(r[0], r[1]) for r in odd_rows])


def test_empty_table_and_no_training_rows(spark, no_docs):
    assert S.op2_lm_scoring(no_docs).count() == 0
    only = spark.createDataFrame([(1, "a b", False)], "doc_id long, text string, train boolean")
    row = S.score_texts(only, "train").first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)
    assert row["score"] < 0


def scores(found, places=3):
    return sorted((str(r["doc_id"]), r["n_known"], round(r["base_score"], 6), round(r["score"], places)) for r in found)


def test_the_list_of_frequent_pairs_changes_no_score(spark, sf001, monkeypatch):
    docs = documents(spark, sf001)
    first = scores(S.op2_lm_scoring(docs).collect(), 2)
    for most in (0, 300):
        monkeypatch.setattr(S, "LISTED", most)
        again = scores(S.op2_lm_scoring(docs).collect(), 2)
        assert [x[:3] for x in again] == [x[:3] for x in first]
        assert [x[3] for x in again] == pytest.approx([x[3] for x in first], rel=1e-6, abs=0.02)


def test_scores_do_not_depend_on_partitions(spark, sf001, monkeypatch):
    """Several deals, learned from apart: the same scores with 1 and 8 shuffle
    partitions, and however the texts lie in tasks."""
    monkeypatch.setattr(S, "DEAL_TOKENS", 20_000)
    docs = documents(spark, sf001)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for width, df in (("1", docs), ("8", docs), ("8", docs.repartition(5))):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            got.append(scores(S.op2_lm_scoring(df).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for other in got[1:]:
        assert [x[:3] for x in other] == [x[:3] for x in got[0]]
        assert [x[3] for x in other] == pytest.approx([x[3] for x in got[0]], rel=1e-5, abs=0.01)


def test_few_codes_leave_the_rest_rare_and_right(spark, sf001, monkeypatch):
    """With hardly any codes nearly all tokens go through the join; base and known tokens stay exact."""
    monkeypatch.setattr(S, "KNOWN", 50)
    docs = documents(spark, sf001)
    found = S.op2_lm_scoring(docs).collect()
    check(found, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all(r["score"] < 0 for r in found)


def test_repeated_rows_each_get_the_same_score(spark, sf001):
    docs = documents(spark, sf001).limit(60)
    found = S.score_texts(docs.union(docs).withColumn("train", S.F.col("doc_id") % 2 == 0), "train").collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(round(r["score"], 4))
    assert all(len(v) == 2 and v[0] == pytest.approx(v[1], abs=0.01) for v in by_id.values())


def test_a_score_depends_on_the_order_of_tokens(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[(i + j) % 40] for j in range(40)), True) for i in range(120)]
    shuffled = [words[j * 7 % 40] for j in range(40)]
    rows += [(1000, " ".join(words), False), (1001, " ".join(shuffled), False)]
    found = {r["doc_id"]: r for r in S.score_texts(spark.createDataFrame(rows, "doc_id long, text string, train boolean"), "train").collect()}
    assert found[1000]["base_score"] == pytest.approx(found[1001]["base_score"])
    assert found[1000]["score"] > found[1001]["score"] + 10


def test_large_contexts_count_the_same(spark, monkeypatch):
    rows = [(i, " ".join(f"a t{i} a t{i * 7 % 60} b t{j}" for j in range(3)), i % 5 > 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    flat = S.np.zeros((S.CLASSES, S.DIMS), S.np.float32)
    words = S.vocabulary(docs.select("text", "train"), flat)
    known, totals = S.known_tokens(words, 60, 48)

    def counted(share):
        monkeypatch.setattr(S, "LARGE_SHARE", share)
        large = S.large_contexts(words, totals, 60, 30)
        setting = S.Setting(known, flat, S.Lookup(S.np.zeros(0, S.np.uint64)), large, 5, totals.lessen, 30)
        emitted = S.cut(S.emit(docs, setting, "bigint"), "emitted")
        deals = S.cut(S.merged_deals(emitted), "deals")
        model = S.fit(words, emitted, deals, totals, large)
        seen = {}
        for r in deals.collect():
            d = S.Deal.read(bytes(r["blob"]))
            for part in d.blocks(1):
                *_, following = model._block(d, part)
                pairs = zip(*(x.tolist() for zero, one in following for x in (zero, one)), strict=True)
                seen |= dict(zip(d.keys[part].tolist(), pairs, strict=True))
        return len(large), seen

    none, first = counted(1)
    one, second = counted(4)
    many, third = counted(1000)
    assert (none, one) == (0, 1) and many > 50
    assert first == second == third


def test_counts_after_a_context_equal_brute_force():
    bits, top = S.CODE_BITS, S.ContextCounts.TOP_BITS
    rng = S.np.random.default_rng(1)
    ctx, codes, c = S.np.sort(rng.integers(0, 5, 500)), rng.integers(0, 1 << bits, 500), rng.integers(0, 4, 500)
    codes[::3] &= 0x3F00
    order = S.np.lexsort((codes, ctx))
    ctx, codes, c = ctx[order], codes[order], c[order]
    tops = S.np.array([S.np.bincount(codes[ctx == k] >> (bits - top), weights=c[ctx == k], minlength=1 << top) for k in (1, 3)])
    for model in (S.ContextCounts(S.np.zeros(0, S.np.int64), S.np.zeros((0, 1 << top))), S.ContextCounts(S.np.array([1, 3]), tops)):
        for depth, (zero, one) in enumerate(model.counts(ctx, codes, c)):
            for i in range(0, 500, 37):
                same = (ctx == ctx[i]) & (codes >> (bits - depth) == codes[i] >> (bits - depth))
                ones = (codes >> (bits - 1 - depth)) & 1
                assert (zero[i], one[i]) == (c[same & (ones == 0)].sum(), c[same & (ones == 1)].sum())


def vectors(texts):
    return S.histograms(S.pa.array([t.encode() for t in texts], S.pa.large_binary()))


def test_classes_come_from_all_training_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "CLUSTER_TEXTS", 40)
    kinds = ["the of and to in that", "der die und das nicht ein", "le la les des et que", "0123 4567 89 10 11"]
    texts = [f"{kinds[i % 4]} {i * 7919 % 1000} {kinds[i % 4][: i % 9]}" for i in range(400)]
    docs = spark.createDataFrame([(t, True) for t in texts], "text string, train boolean").repartition(3)
    found = S.text_classes(docs, 400)
    x = S.np.rint(vectors(texts) * 255)
    own = S.np.argmax(x.astype(S.np.float32) @ found.T, axis=1)
    for k in set(own.tolist()):
        total = x[own == k].sum(axis=0)
        assert total @ found[k] > 0.99 * S.np.linalg.norm(total)
        assert len({i % 4 for i in S.np.flatnonzero(own == k)}) == 1  # a class is of one kind


def test_histograms_do_not_cross_texts():
    x = vectors(["ab", "", "a", "ABab"])
    assert (x[1] == 0).all() and (x[2] == 0).all()
    assert x[0].max() == pytest.approx(1.0) and S.np.count_nonzero(x[0]) == 1
    assert x[3] @ x[0] > 0.7


def test_odds_with_one_left_out_equal_brute_force():
    rng = S.np.random.default_rng(3)
    leaves, ends = rng.integers(0, 3, (S.CLASSES, 1 << S.CODE_BITS)), rng.integers(0, 3, (S.DIMS, 1 << S.ContextCounts.TOP_BITS))
    model = S.CodeModel(leaves, ends)
    n = 40
    cls, end, codes = rng.integers(0, S.CLASSES, n), rng.integers(0, S.DIMS, n), rng.integers(0, 1 << S.CODE_BITS, n)
    nothing = [(S.np.zeros(n, S.np.float32), S.np.zeros(n, S.np.float32))] * S.CODE_BITS
    odds = lambda z, o: math.log((max(o, 0) + 0.4) / (max(z, 0) + 0.4))
    for own in (True, False):
        for depth, (stretch, _, bit) in enumerate(model.bits(cls, end, codes, iter(nothing), own)):
            width = S.CODE_BITS - depth - 1
            for i in range(n):
                lo = (int(codes[i]) >> (width + 1)) << (width + 1)
                z, o = leaves[cls[i], lo : lo + (1 << width)].sum(), leaves[cls[i], lo + (1 << width) : lo + (2 << width)].sum()
                less = int(own)
                assert stretch[2][i] == pytest.approx(odds(z - less * (bit[i] == 0), o - less * bit[i]), abs=1e-4)


def test_lookup_equals_a_dictionary():
    rng = S.np.random.default_rng(5)
    for n in (0, 1, 2, 7, 5000):
        values = S.np.unique(rng.integers(0, 1 << 63, n).astype(S.np.uint64) << S.np.uint64(rng.integers(0, 2)))
        values = S.np.unique(S.np.append(values, values[: n // 2] + S.np.uint64(1)))
        found = S.Lookup(values)
        asked = S.np.concatenate([values, values + S.np.uint64(2), S.np.zeros(2, S.np.uint64)])
        own = set(values.tolist())
        for v, at in zip(asked.tolist(), found.find(asked).tolist(), strict=True):
            assert (at >= 0) == (v in own) and (at < 0 or found.values[at] == v)


def test_packed_arrays_come_back():
    rng = S.np.random.default_rng(2)
    for n in (0, 1, 5, 1000):
        k = S.np.sort(rng.integers(0, 1 << 63, n).astype(S.np.uint64) * S.np.uint64(2))
        v, w = rng.integers(0, 1 << 32, n // 2, dtype=S.np.uint32), rng.normal(size=n).astype(S.np.float32)
        for a, b in zip((k, v, w), S._unpack(S._pack(k, v, w), S.np.uint64, S.np.uint32, S.np.float32), strict=True):
            assert a.dtype == b.dtype and (a == b).all()


def test_hashes_are_sparks(spark):
    texts = ["a b", "Word wörd 日本", "x" * 5000]
    column = S.pa.array([t.encode() for t in texts], S.pa.large_binary())
    w = S.single_spaced(S.split_words(column, S.NOT_SPACE))
    tokens = [bytes(t) for t in S.token_array(w).to_pylist()]
    df = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(tokens)], "i int, t binary")
    want = [r[0] for r in df.orderBy("i").select(S.F.xxhash64("t")).collect()]
    assert S.token_hash(w).view(S.np.int64).tolist() == want


def test_every_once_seen_token_trains_the_spelling():
    tokens = [b"token%d" % i for i in range(50)]
    spell = S.SpellModel(18)
    mixer = S.Mixer.fresh(spell.GATES, spell.PREDICTORS)
    model = S.Model(None, None, None, spell, mixer)
    assert model.learn_spelling(tokens, S.np.zeros(50, S.np.int64), mixer) == 50
    assert mixer.hits[1].sum() == 8 * sum(len(t) + 1 for t in tokens)


def test_spelling_tables_grow_with_the_tokens():
    assert [S.SpellModel.slot_bits(n) for n in (0, 1 << 17, 1 << 19, 1 << 40)] == [18, 19, 21, 21]


def test_intermediates_are_removed(spark, sf001):
    import os

    from lakemart.llm.common import run_folder

    folder = run_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    S.op2_lm_scoring(documents(spark, sf001)).collect()
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left == {"vocabulary", "emitted", "answers"}  # what the result is read from
    pairs = [p for name in set(os.listdir(folder)) - before if name.startswith("emitted") for p in os.listdir(f"{folder}/{name}") if p == "_part=yes"]
    assert not pairs
