"""Queries over the given tables, with the expected results as SQL."""
