"""Reusable relational operators (ordering, keys, reshaping, quality, change data)."""
