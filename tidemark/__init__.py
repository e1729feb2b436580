"""Tidemark: ready-made data jobs for Spark DataFrames and streams."""
