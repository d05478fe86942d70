"""Incremental processing of newly landed days."""
