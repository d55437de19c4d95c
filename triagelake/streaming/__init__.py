"""Incremental runs of the same stages."""
