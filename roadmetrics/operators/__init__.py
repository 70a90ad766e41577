"""Reusable relational operators for time series: alignment, islands, windows, statistics."""
