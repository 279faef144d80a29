"""Column helpers and fixed label tables."""
