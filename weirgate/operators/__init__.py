"""Table jobs: each function maps DataFrames to a DataFrame."""
