import math

from pyspark.sql import functions as F

from lakemart.llm import language_id as L
from lakemart.llm.common import fold

from .conftest import documents


def test_held_out_accuracy_and_folds(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = L.op1_language_id(docs).join(docs.select("doc_id", "lang", fold(F.col("doc_id")).alias("f"), F.length("text").alias("n")), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (r["f"] == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and r["n"] > 40]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)


def test_labels_of_the_held_out_fold_are_not_used(spark, sf001):
    docs = documents(spark, sf001)
    spoiled = docs.withColumn("lang", F.when(fold(F.col("doc_id")) == 0, F.lit("zz")).otherwise(F.col("lang")))
    as_rows = lambda df: sorted(map(tuple, df.collect()))
    assert as_rows(L.op1_language_id(docs)) == as_rows(L.op1_language_id(spoiled))


def test_rejects_by_distance(spark, sf001):
    model = L.fit(L.training_rows(documents(spark, sf001)))
    far = spark.createDataFrame([(1, "日本語のテキスト" * 20), (2, "zzqx kkjw vvwq " * 20)], "doc_id long, text string")
    assert all(r["rejected"] for r in L.identify(far, model).collect())


def test_odd_rows(spark, odd_docs, odd_rows, sf001):
    model = L.fit(L.training_rows(documents(spark, sf001)))
    rows = L.identify(odd_docs, model).collect()
    assert len(rows) == len(odd_rows)
    for r, source in zip(rows, odd_rows):
        letters = any(map(str.isalpha, source[1] or ""))
        assert (r["lang_pred"] == "und") == (not letters)
        if not letters:
            assert r["score"] == 0 and r["rejected"]
    kept = L.keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns


def test_empty_tables(spark, no_docs, odd_docs):
    assert L.op1_language_id(no_docs).count() == 0
    assert {r["lang_pred"] for r in L.identify(odd_docs, L.fit(L.training_rows(no_docs))).collect()} == {"und"}


def plain_vector(text, idf):
    """Normalised TF-IDF of hashed byte n-grams, one n-gram at a time in plain integers."""
    c = [b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in text.encode()]
    mask, x = 0xFFFFFFFF, {}
    for i in range(len(c)):
        slots = [c[i]]
        if i + 1 < len(c):
            two = (c[i] * 0x9E3779B1 + c[i + 1] * 0x85EBCA6B) & mask
            slots.append(256 + (two >> 22) % 768)
            if i + 2 < len(c):
                three = (two * 0x27D4EB2F + c[i + 2] * 0xC2B2AE35) & mask
                slots.append(1024 + (three >> 16) % 3072)
        for s in slots:
            x[s] = x.get(s, 0) + 1
    x = {s: math.log1p(n) * float(idf[s]) for s, n in x.items()}
    norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
    return {s: v / norm for s, v in x.items()}


def test_nearest_centroid_equals_plain_python(spark, sf001):
    docs = documents(spark, sf001)
    model = L.fit(L.training_rows(docs))
    train = [r for r in docs.select("doc_id", "text", "lang").collect() if r["text"] is not None]
    learned = {r["text"] for r in L.training_rows(docs).where("text is not null and lang is not null").collect()}
    df = [0] * L.DIMS
    ones = [1.0] * L.DIMS
    for t in learned:  # all of them: fewer than the sample's bound
        for s in plain_vector(t, ones):
            df[s] += 1
    idf = [math.log((1 + len(learned)) / (1 + n)) + 0.05 for n in df]
    assert max(abs(a - b) for a, b in zip(idf, model.idf.tolist())) < 1e-5
    got = {r["doc_id"]: r for r in L.identify(docs, model).collect()}
    for r in train[:120]:
        x = plain_vector(r["text"], idf)
        cosines = [sum(v * float(c[s]) for s, v in x.items()) for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        lang = model.languages[model.owner[best]]
        g = got[r["doc_id"]]
        if any(map(str.isalpha, r["text"])):
            assert g["lang_pred"] == lang and abs(g["score"] - min(max(cosines[best], 0), 1)) < 1e-4
            assert g["rejected"] == (g["score"] < model.threshold[model.owner[best]])


def test_rows_of_one_id_do_not_enter_the_sample_together(spark):
    rows = [(None, f"the quick brown fox number {i} jumps over it", "en") for i in range(4000)]
    p = L.Params(sample_per_language=100)
    model = L.fit(spark.createDataFrame(rows, "id long, text string, lang string"), p)
    assert model.languages == ("en",) and len(model.centroids) == p.clusters
