"""Operators for training data: quality, toxicity, secrets, languages, mixing, packing, joins, search, sharding."""
