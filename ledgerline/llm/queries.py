"""Registered queries of this package and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    filter_audit, html_text, minhash, nearest, packing, pieces, quality_knn, quality_rules, simhash, substring_dedup, toxicity, turn_trie,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": minhash.query,
    "op2_warc": warc.query,
    "op3_nearest_neighbours": nearest.query,
    "op4_quality_classifier": quality_knn.query,
    "op5_quality_rules": quality_rules.query,
    "op6_piece_encoding": pieces.query,
    "op7_toxicity": toxicity.query,
    "op8_packing": packing.query,
    "op9_html_extraction": html_text.query,
    "op10_substring_dedup": substring_dedup.query,
    "op11_filter_interaction_audit": filter_audit.query,
    "op12_simhash_near_dedup": simhash.query,
    "op13_conversation_prefix_trie": turn_trie.query,
}

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": minhash.SQL,
    "op2_warc": warc.SQL,
    "op3_nearest_neighbours": nearest.SQL,
    "op5_quality_rules": quality_rules.SQL,
    "op11_filter_interaction_audit": filter_audit.SQL,
    "op13_conversation_prefix_trie": turn_trie.SQL,
}
