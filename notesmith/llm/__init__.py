"""Operators for training-data pipelines: scans, deduplication, sharding, rules, mixing and byte-level BPE."""
