"""Structured Streaming entry points (stateless: classification of arriving records)."""
