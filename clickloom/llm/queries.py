"""The registered queries of this package, and their SQL."""

from __future__ import annotations

from . import op1_minhash, op2_url_filter, op3_substring, op4_decontaminate, op5_toxicity, op6_license, op7_pivot_index, op8_packing, op9_gru_lm, op10_suffix_array, op11_digest_index, op12_hard_negatives, op13_dual_tree

QUERIES = {
    "op1_near_duplicates": op1_minhash.query,
    "op2_url_filter": op2_url_filter.query,
    "op3_substring_dedup": op3_substring.query,
    "op4_decontamination": op4_decontaminate.query,
    "op5_toxicity": op5_toxicity.query,
    "op6_license_scan": op6_license.query,
    "op7_exact_top_k": op7_pivot_index.query,
    "op8_packing": op8_packing.query,
    "op9_lm_scores": op9_gru_lm.query,
    "op10_suffix_array_dedup": op10_suffix_array.query,
    "op11_exact_dedup": op11_digest_index.query,
    "op12_hard_negatives": op12_hard_negatives.query,
    "op13_dual_tree_clustering": op13_dual_tree.query,
}

ORACLES = {
    "op1_near_duplicates": op1_minhash.SQL,
    "op2_url_filter": op2_url_filter.SQL,
    "op3_substring_dedup": op3_substring.SQL,
    "op6_license_scan": op6_license.SQL,
    "op7_exact_top_k": op7_pivot_index.SQL,
    "op10_suffix_array_dedup": op10_suffix_array.SQL,
    "op11_exact_dedup": op11_digest_index.SQL,
    "op12_hard_negatives": op12_hard_negatives.SQL,
    "op13_dual_tree_clustering": op13_dual_tree.SQL,
}
