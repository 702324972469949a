"""Operators for training-data pipelines: scans, rules, packing, extraction, duplicates, shards."""
