"""Readers and writers for files, catalog tables and streams."""
