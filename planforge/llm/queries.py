"""Queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, divergence, exact_dedup, histogram_packing, impact_search, lm_scoring, mixing, near_dedup, packing, pii, topk_search, toxicity, url_filter

QUERIES = {
    "op1_lm_scoring": lm_scoring.query,
    "op2_near_dedup": near_dedup.query,
    "op3_exact_dedup": exact_dedup.query,
    "op4_bpe": bpe.query,
    "op5_pii": pii.query,
    "op6_topk_search": topk_search.query,
    "op7_toxicity": toxicity.query,
    "op8_mixing": mixing.query,
    "op9_url_filter": url_filter.query,
    "op10_packing": packing.query,
    "op11_histogram_packing": histogram_packing.query,
    "op12_divergence": divergence.query,
    "op13_impact_search": impact_search.query,
}
ORACLES = {"op2_near_dedup": near_dedup.ORACLE, "op3_exact_dedup": exact_dedup.ORACLE, "op6_topk_search": topk_search.ORACLE, "op9_url_filter": url_filter.ORACLE, "op12_divergence": divergence.ORACLE, "op13_impact_search": impact_search.ORACLE}
