"""Readers, adapters for the benchmark tables, and writers."""
