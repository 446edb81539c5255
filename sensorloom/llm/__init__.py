"""Operators for large text, page, vector and media collections, and their queries."""
