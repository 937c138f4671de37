"""Operators: each takes DataFrames and returns DataFrames, and runs no action."""
