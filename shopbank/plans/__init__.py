"""Batch jobs: which operators run together and over which tables."""
