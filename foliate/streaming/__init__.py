"""Incremental merges as streaming queries."""
