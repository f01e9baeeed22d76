"""The subpackage's queries and their DuckDB oracles."""

from __future__ import annotations

from . import bpe, chat, collocations, debruijn, decontamination, html_text, importance, jaccard, line_dedup, quality, sharding, suffix_dedup, toxicity

QUERIES = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_suffix_array_dedup": suffix_dedup.op2_suffix_array_dedup,
    "op3_sharding": sharding.op3_sharding,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_ngram_jaccard_join": jaccard.op6_ngram_jaccard_join,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_html_extraction": html_text.op8_html_extraction,
    "op9_bpe": bpe.op9_bpe,
    "op10_decontamination": decontamination.op10_decontamination,
    "op11_substring_dedup": debruijn.op11_substring_dedup,
    "op12_importance_resampling": importance.op12_importance_resampling,
    "op13_collocations": collocations.op13_collocations,
}

SQL = {
    "op4_line_dedup": line_dedup.ORACLE,
    "op11_substring_dedup": debruijn.ORACLE,
    "op12_importance_resampling": importance.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
