"""The queries of this subpackage and their SQL, for the driver's entry module."""

from __future__ import annotations

from siltstone.llm import chat, exact_dedup, license_scan, metric_search, near_dedup, packing, pieces, sharding, substring_dedup, toxicity

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_metric_search": metric_search.op3_metric_search,
    "op4_packing": packing.op4_packing,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_chat_formatting": chat.op6_chat_formatting,
    "op7_sharding": sharding.op7_sharding,
    "op8_near_dedup": near_dedup.op8_near_dedup,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
}
ORACLES = {
    "op1_license_scan": license_scan.SQL,
    "op2_substring_dedup": substring_dedup.SQL,
    "op3_metric_search": metric_search.SQL,
    "op6_chat_formatting": chat.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
}
