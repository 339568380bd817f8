"""Marts, reports, normalization and analytics built on the operators."""
