"""The subpackage's registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bytebpe, classifier, codes, dedup, near, packing, phrases, rules, sharding, tokenfiles, topk, warc

QUERIES = {f.__name__: f for f in (
    sharding.op1_sampled_splitters, dedup.op2_grace_dedup, packing.op3_sum_of_squares, classifier.op4_weak_label, tokenfiles.op5_ranked_varint,
    rules.op6_voting_rules, near.op7_lsh_forest, tokenfiles.op8_separator_scan, bytebpe.op9_byte_bpe, warc.op10_salvage_warc,
    topk.op11_norm_sorted_topk, codes.op12_metric_tree_codes, phrases.op13_prefix_free_phrases,
)}
ORACLE_SQL = {
    "op1_sampled_splitters": sharding.OP1_SQL, "op2_grace_dedup": dedup.OP2_SQL, "op6_voting_rules": rules.OP6_SQL, "op7_lsh_forest": near.OP7_SQL, "op10_salvage_warc": warc.OP10_SQL,
    "op11_norm_sorted_topk": topk.OP11_SQL, "op12_metric_tree_codes": codes.OP12_SQL, "op13_prefix_free_phrases": phrases.OP13_SQL,
}
