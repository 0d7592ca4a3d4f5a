"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterloom.llm import (
    bpe,
    conversation_repair,
    exact_dedup,
    language_id,
    lm_scoring,
    mixing,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    token_alignment,
    token_files,
    toxicity,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_bpe_roundtrip": bpe.op3_bpe_roundtrip,
    "op4_mixing": mixing.op4_mixing,
    "op5_token_files": token_files.op5_token_files,
    "op6_simhash_dedup": simhash_dedup.op6_simhash_dedup,
    "op7_lm_scoring": lm_scoring.op7_lm_scoring,
    "op8_language_id": language_id.op8_language_id,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_url_filters": url_filters.op11_url_filters,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op11_url_filters": url_filters.SQL,
}
