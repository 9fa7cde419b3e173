"""Operators for training-data pipelines: search, sharding, joins, models, packing and tokens."""
