"""Readers: every one names its schema, so nothing is inferred by an extra pass."""
