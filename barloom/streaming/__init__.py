"""Incremental operators."""
