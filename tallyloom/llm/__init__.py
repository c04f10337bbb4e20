"""Operators that prepare training data for language models.

Each module holds one operator with its own interface; ``catalogue`` registers the thin
queries that apply them to the given tables, and their SQL.
"""
