"""Operators of a training-data pipeline: deduplication, quality, mixing, sharding, scoring and scans of documents."""
