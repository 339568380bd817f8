"""Readers, writers and the mapping of source tables onto the shop model."""
