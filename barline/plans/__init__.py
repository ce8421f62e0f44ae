"""Composed plans: quality checks, monitoring queries, run log, the daily run,
and the registry of named queries."""
