"""Operators over DataFrames: key ranges, cells, load policies and load
quality (fan-out, reconciliation, dirty rows, budgets, statistics)."""
