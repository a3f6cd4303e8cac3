"""Incremental staging of newly landed days as a file stream."""
