"""The queries of this subpackage and, where SQL can say it, their DuckDB counterparts."""

from __future__ import annotations

from . import chat, divergence, infill, licenses, line_dedup, media, mixing, pieces, quality, sharding, similarity, token_files, toxicity

QUERIES = {
    "op1_sentencepiece": pieces.query,
    "op2_license_scan": licenses.query,
    "op3_source_mixing": mixing.query,
    "op4_ngram_jaccard": similarity.query,
    "op5_chat_format": chat.query,
    "op6_token_files": token_files.query,
    "op7_media": media.query,
    "op8_quality_rules": quality.query,
    "op9_toxicity": toxicity.query,
    "op10_sharding": sharding.query,
    "op11_line_dedup": line_dedup.query,
    "op12_fill_in_middle": infill.query,
    "op13_source_divergence": divergence.query,
}

ORACLES = {"op5_chat_format": chat.ORACLE, "op11_line_dedup": line_dedup.ORACLE, "op12_fill_in_middle": infill.ORACLE, "op13_source_divergence": divergence.ORACLE}
