"""Operators that prepare text corpora for training: sharding, archives, packing, extraction, filters, joins."""
