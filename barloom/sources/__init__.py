"""Readers of bars, benchmarks and reference tables."""
