"""Column functions and user-function wrappers."""
