"""Batch jobs: each takes DataFrames and returns a DataFrame."""
