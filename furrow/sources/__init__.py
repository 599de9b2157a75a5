"""Readers, writers and column contracts of the raw sources."""
