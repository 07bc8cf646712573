"""Operators for preparing training data: mixing, language identification,
toxicity, quality, near-duplicate joins, sharding, substring deduplication,
web archives and benchmark decontamination.

Nothing outside this subpackage imports it.
"""
