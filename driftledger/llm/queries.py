"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from driftledger.llm import bpe, exact_dedup, language, mixing, packing, quality, rules, search, simhash, suffixes, token_counts, toxicity, whitening

QUERIES = {
    "op1_best_fit_packing": packing.op1_packing,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_suffix_dedup": suffixes.op3_suffix_dedup,
    "op4_quality_rules": rules.op4_quality_rules,
    "op5_quality_classifier": quality.op5_quality_classifier,
    "op6_mixing": mixing.op6_mixing,
    "op7_language_id": language.op7_language_id,
    "op8_simhash": simhash.op8_simhash,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_byte_bpe": bpe.op11_byte_bpe,
    "op12_lexical_search": search.op12_lexical_search,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES = {
    "op6_mixing": mixing.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op12_lexical_search": search.SQL,
}
