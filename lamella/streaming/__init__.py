"""Incremental slabs."""
