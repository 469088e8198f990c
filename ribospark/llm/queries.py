"""Queries of this subpackage and their DuckDB equivalents, by name."""

from __future__ import annotations

from . import embedding_dedup, jaccard_join, packing, pitman_yor, quality_classifier, quality_rules, sentencepiece_lattice, suffix_dedup, token_store, url_filters

QUERIES = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_embedding_dedup": embedding_dedup.op3_embedding_dedup,
    "op4_token_store": token_store.op4_token_store,
    "op5_quality_classifier": quality_classifier.op5_quality_classifier,
    "op6_lm_scoring": pitman_yor.op6_lm_scoring,
    "op7_ngram_jaccard_join": jaccard_join.op7_ngram_jaccard_join,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_sentencepiece": sentencepiece_lattice.op9_sentencepiece,
    "op10_suffix_array_dedup": suffix_dedup.op10_suffix_array_dedup,
}
ORACLES = {
    "op1_url_filters": url_filters.ORACLE,
    "op2_quality_rules": quality_rules.ORACLE,
    "op3_embedding_dedup": embedding_dedup.ORACLE,
    "op7_ngram_jaccard_join": jaccard_join.ORACLE,
}
