"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import byte_bpe, decontaminate, html_extract, language_id, license_scan, lm_score, mixing, prefix_trie, quality, sharding, simhash, token_counts, whitening

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_lm_score": lm_score.op3_lm_score,
    "op4_mixing": mixing.op4_mixing,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_sharding": sharding.op6_sharding,
    "op7_language_id": language_id.op7_language_id,
    "op8_quality": quality.op8_quality,
    "op9_html_extract": html_extract.op9_html_extract,
    "op10_simhash": simhash.op10_simhash,
    "op11_whitening": whitening.op11_whitening,
    "op12_byte_bpe": byte_bpe.op12_byte_bpe,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

# the others are no SQL: fitted models, Bloom filters, a tokenizer library, DOM trees, XXH64 bit votes;
# tests/llm compares them with brute-force versions
SQL = {
    "op1_license_scan": license_scan.OP1_SQL,
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op6_sharding": sharding.OP6_SQL,
    "op8_quality": quality.OP8_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
