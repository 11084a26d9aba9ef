"""Structured Streaming forms of ingestion, rollup and detection."""
