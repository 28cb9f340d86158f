"""Operators for training-data pipelines: texts, pages, duplicates, shards and tokens."""
