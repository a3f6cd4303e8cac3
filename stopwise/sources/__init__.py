"""Readers for landed documents and metadata, and the landing writer."""
