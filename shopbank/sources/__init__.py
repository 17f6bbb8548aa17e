"""Readers and schemas."""
