"""The queries of this subpackage by name, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import chat_format, fill_in_middle, merkle_manifest, source_mixing, topk_search
from lakemart.llm.chat_format import op5_chat_format
from lakemart.llm.common import table
from lakemart.llm.decontamination import op3_decontamination
from lakemart.llm.fill_in_middle import op12_fill_in_middle
from lakemart.llm.language_id import op1_language_id
from lakemart.llm.license_scan import op8_license_scan
from lakemart.llm.lm_scoring import op2_lm_scoring
from lakemart.llm.merkle_manifest import op13_merkle_manifest
from lakemart.llm.packing import op10_best_fit_packing
from lakemart.llm.quality import op4_quality
from lakemart.llm.simhash_dedup import op6_simhash_dedup
from lakemart.llm.source_mixing import op11_source_mixing
from lakemart.llm.token_counts import op7_token_counts
from lakemart.llm.topk_search import op9_topk_search

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": lambda s, d: op1_language_id(_docs(s, d)),
    "op2_lm_scoring": lambda s, d: op2_lm_scoring(_docs(s, d)),
    "op3_decontamination": lambda s, d: op3_decontamination(_docs(s, d), table(s, d, "benchmark")),
    "op4_quality": lambda s, d: op4_quality(_docs(s, d), table(s, d, "labels")),
    "op5_chat_format": lambda s, d: op5_chat_format(table(s, d, "conversations")),
    "op6_simhash_dedup": lambda s, d: op6_simhash_dedup(_docs(s, d)),
    "op7_token_counts": lambda s, d: op7_token_counts(_docs(s, d), tokenizer_path()),
    "op8_license_scan": lambda s, d: op8_license_scan(_docs(s, d)),
    "op9_topk_search": lambda s, d: op9_topk_search(table(s, d, "embeddings")),
    "op10_best_fit_packing": lambda s, d: op10_best_fit_packing(_docs(s, d), tokenizer_path()),
    "op11_source_mixing": lambda s, d: op11_source_mixing(_docs(s, d)),
    "op12_fill_in_middle": lambda s, d: op12_fill_in_middle(_docs(s, d)),
    "op13_merkle_manifest": lambda s, d: op13_merkle_manifest(_docs(s, d)),
}

ORACLE_SQL: dict[str, str] = {
    "op5_chat_format": chat_format.ORACLE_SQL,
    "op9_topk_search": topk_search.ORACLE_SQL,
    "op11_source_mixing": source_mixing.ORACLE_SQL,
    "op12_fill_in_middle": fill_in_middle.ORACLE_SQL,
    "op13_merkle_manifest": merkle_manifest.ORACLE_SQL,
}
