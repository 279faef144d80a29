"""Declared schemas, file sources and the table store."""
