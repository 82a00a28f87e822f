"""Incremental loads, in batch and as streams."""
