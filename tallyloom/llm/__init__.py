"""Operators of a training-data pipeline: sharding, dedup, formatting, packing,
search, secret scans, toxicity, quality, mixing and token files.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
