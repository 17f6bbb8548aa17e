"""Structured Streaming operators, sinks and jobs."""
