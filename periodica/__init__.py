"""Spark operators for periodic reporting data."""
