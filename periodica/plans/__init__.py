"""Compositions of operators: the reporting models and table writers."""
