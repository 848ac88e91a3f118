"""Queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from . import conversations, exact_dedup, html_text, language, mixing, pieces, quality, secrets, sharding, simhash, substring_dedup, url_filter, vector_codes

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_sharding": sharding.op2_sharding,
    "op3_language_id": language.op3_language_id,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_simhash_dedup": simhash.op9_simhash_dedup,
    "op10_mixing": mixing.op10_mixing,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_html_extraction": html_text.op13_html_extraction,
}
ORACLE = {
    "op1_quality_rules": quality.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op7_url_filter": url_filter.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_conversation_repair": conversations.SQL,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
