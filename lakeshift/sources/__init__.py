"""Readers, catalog access and writers."""
