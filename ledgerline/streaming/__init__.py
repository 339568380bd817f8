"""Structured Streaming jobs that keep marts up to date."""
