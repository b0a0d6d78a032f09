"""Operators for building training data: quality, duplicates, leaks, tokens, archives."""
