"""Operators over DataFrames: every function takes frames and names and returns a lazy frame."""
