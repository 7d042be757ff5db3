"""Operators of a training-data pipeline: language ID, decontamination, sharding,
secret and license scans, vector search, near-duplicate and repeat removal,
subword sampling. Nothing outside this package imports it."""
