"""Queries of this folder and their SQL."""

from __future__ import annotations

from notesmith.llm import angle_negatives, byte_bpe, exact_dedup, factor_machine, label_shards, license_scan, minhash_hamming, quality_rules, reversed_search, secret_scan, sentence_spans, source_mix, suffix_dedup

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_sentence_spans": sentence_spans.op3_sentence_spans,
    "op4_byte_bpe": byte_bpe.op4_byte_bpe,
    "op5_minhash_hamming": minhash_hamming.op5_minhash_hamming,
    "op6_label_shards": label_shards.op6_label_shards,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_source_mix": source_mix.op8_source_mix,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_reversed_search": reversed_search.op11_reversed_search,
    "op12_factor_machine": factor_machine.op12_factor_machine,
    "op13_angle_negatives": angle_negatives.op13_angle_negatives,
}

ORACLE = {
    "op7_quality_rules": quality_rules.ORACLE,
    "op9_secret_scan": secret_scan.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_reversed_search": reversed_search.ORACLE,
    "op13_angle_negatives": angle_negatives.ORACLE,
}
