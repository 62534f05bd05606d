"""Incremental runs of the stateless part."""
