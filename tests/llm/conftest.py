from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 700}" for i in range(30_000))


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs far away", "en", "s", 5),
        (2, None, "en", None, None),
        (3, "", None, "s", 0),
        (4, " \t\n ", "en", "s", 4),
        (5, "123 ... !!!", "en", "s", 5),
        (6, LONG, "en", "s", len(LONG)),
        (7, "a b", "en", "s", 3),
        (7, "a b", "en", "s", 3),
        (7, "other text with the same id", "en", "s", 3),
        (None, "no id at all but text", None, None, None),
        (None, None, None, None, None),
        (8, "É ß 日本 naïve café Straße 日本語", "de", "s", 9),
        (9, "x" * 20_000, "en", "s", 20_000),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows, with extra columns that clash with names the operators use."""
    df = spark.createDataFrame(odd_rows, DOCS_SCHEMA)
    for name in ("id", "fp", "root", "token", "score", "uid", "windows", "length", "train", "_llm_item", "text_key", "cls"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS_SCHEMA)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
