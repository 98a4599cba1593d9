"""Operators on DataFrames: search, windows over logs, graphs, consensus."""
