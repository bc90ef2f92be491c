"""Readers of the raw files; readers and writers of the derived tables."""
