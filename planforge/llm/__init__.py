"""Training-data operators: scoring, dedup, tokenising, PII, search, toxicity, mixing, URL rules, packing."""
