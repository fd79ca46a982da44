"""Structured Streaming: parse, deduplicate and score prediction requests."""
