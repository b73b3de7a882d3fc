"""Structured Streaming forms: gathering, deduplication, revisit gate, tokenizing."""
