"""Operators on DataFrames, with column names as parameters."""
