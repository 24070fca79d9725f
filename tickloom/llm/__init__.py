"""Operators for preparing training data: tokens, packing, sharding, near-duplicates, passages, toxicity, search."""
