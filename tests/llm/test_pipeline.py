import corpus_pipeline
from lakemart.llm import quality

from .conftest import documents
from .test_decontamination import brute as contaminated
from .test_packing import check_bins, pieces_of
from .test_simhash_dedup import fingerprint, least_linked

SF = "/root/testdata/sf0.01"


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_every_stage_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = documents(spark, SF)

    good = corpus_pipeline.cut(stages["quality"](spark, docs, SF), "test")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.op4_quality(docs, labels).where("selected").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in scored) == sorted(d for d, _ in texts(good))

    named = corpus_pipeline.cut(stages["language_id"](spark, good, SF), "test")
    assert named.columns == docs.columns and named.count() >= 0.98 * good.count()

    single = corpus_pipeline.cut(stages["simhash_dedup"](spark, named, SF), "test")
    rows = texts(named)
    groups = set(least_linked([fingerprint(t) for _, t in rows], [d for d, _ in rows]))
    assert single.columns == docs.columns and sorted(d for d, _ in texts(single)) == sorted(groups)

    clean = corpus_pipeline.cut(stages["decontamination"](spark, single, SF), "test")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = [w[0] for w in contaminated(texts(single), items) if not w[-1]]
    assert clean.columns == docs.columns and sorted(d for d, _ in texts(clean)) == sorted(want)

    packed = stages["best_fit_packing"](spark, clean, SF).collect()
    assert sorted(tuple(r)[:5] for r in packed) == sorted(pieces_of(texts(clean)))
    check_bins(packed)


def test_run_gives_the_last_stage(spark, sf001):
    found = corpus_pipeline.run(spark, sf001)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 0


def test_stages_take_odd_rows(spark, odd_docs, no_docs, sf001):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            found = stage(spark, docs, sf001)
            found.count()
            if name != "best_fit_packing":
                assert found.columns == docs.columns, name
