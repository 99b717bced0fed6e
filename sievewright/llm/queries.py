"""Queries over the operators of this subpackage, and their SQL where it exists."""

from __future__ import annotations

from . import decontam, fingerprint, forest, htmlextract, langid, linededup, lmscore, mixing, phrases, simhash, spelling, substring, tokencount

QUERIES = {
    "op1_substring_dedup": substring.op1_substring_dedup,
    "op2_language_id": langid.op2_language_id,
    "op3_simhash_near_dedup": simhash.op3_simhash_near_dedup,
    "op4_mixing_sources": mixing.op4_mixing_sources,
    "op5_token_counts": tokencount.op5_token_counts,
    "op6_html_extraction": htmlextract.op6_html_extraction,
    "op7_benchmark_decontamination": decontam.op7_benchmark_decontamination,
    "op8_line_dedup": linededup.op8_line_dedup,
    "op9_document_fingerprints": fingerprint.op9_document_fingerprints,
    "op10_lm_scoring": lmscore.op10_lm_scoring,
    "op11_phrase_mining": phrases.op11_phrase_mining,
    "op12_hash_forest": forest.op12_hash_forest,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLES = {
    "op4_mixing_sources": mixing.ORACLE,
    "op7_benchmark_decontamination": decontam.ORACLE,
    "op8_line_dedup": linededup.ORACLE,
    "op11_phrase_mining": phrases.ORACLE,
}
