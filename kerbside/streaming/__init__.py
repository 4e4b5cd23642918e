"""Structured Streaming twins of cleaning, deduplication, KPIs and scoring."""
