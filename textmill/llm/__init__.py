"""Operators for preparing training data: sharding, search, filtering, near duplicates, privacy, packing, tokens."""
