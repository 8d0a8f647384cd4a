"""A training corpus from ``documents``, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that the next stage gets as its docs. All but the last keep
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import decontamination, language_id, packing, quality, simhash_dedup
from lakemart.llm.common import cut, discard, table
from lakemart.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier selects; it learns from the labelled ones."""
    model = quality.fit(quality.rated_documents(docs, table(spark, sf_dir, "labels")))
    return quality.keep_selected(docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected."""
    return language_id.keep_identified(docs, language_id.fit(language_id.training_rows(docs)))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_dedup.keep_one_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences."""
    return packing.op10_best_fit_packing(docs, tokenizer_path())


STAGES = [
    ("quality", quality_stage),
    ("language_id", language_stage),
    ("simhash_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: Tokens, centroids and fingerprints are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, cut(stage(spark, docs, sf_dir), f"stage-{name}")
        if n:  # the next stage has read it
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
