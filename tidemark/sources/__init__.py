"""Readers for tables, files and streams."""
