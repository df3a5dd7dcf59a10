"""Readers and parsers for release files, seeds and extracts."""
