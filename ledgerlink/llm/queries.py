"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlink.llm import (
    byte_bpe_query,
    chat_windows_query,
    decontamination_query,
    jaccard_join_query,
    main_text_query,
    periodic_runs_query,
    prefix_trie_query,
    quality_rules_query,
    secret_scan_query,
    sharding_query,
    token_counts_query,
    toxicity_query,
    training_order_query,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_windows": chat_windows_query.op1_chat_windows,
    "op2_toxicity": toxicity_query.op2_toxicity,
    "op3_sharding": sharding_query.op3_sharding,
    "op4_benchmark_decontamination": decontamination_query.op4_benchmark_decontamination,
    "op5_token_counts": token_counts_query.op5_token_counts,
    "op6_byte_bpe": byte_bpe_query.op6_byte_bpe,
    "op7_training_order": training_order_query.op7_training_order,
    "op8_jaccard_join": jaccard_join_query.op8_jaccard_join,
    "op9_secret_scan": secret_scan_query.op9_secret_scan,
    "op10_quality_rules": quality_rules_query.op10_quality_rules,
    "op11_main_text": main_text_query.op11_main_text,
    "op12_periodic_runs": periodic_runs_query.op12_periodic_runs,
    "op13_prefix_trie": prefix_trie_query.op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op1_chat_windows": chat_windows_query.SQL,
    "op4_benchmark_decontamination": decontamination_query.SQL,
    "op8_jaccard_join": jaccard_join_query.SQL,
    "op9_secret_scan": secret_scan_query.SQL,
    "op10_quality_rules": quality_rules_query.SQL,
    "op13_prefix_trie": prefix_trie_query.SQL,
}
