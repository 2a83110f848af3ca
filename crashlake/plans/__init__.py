"""Registered queries (catalog) and their DuckDB oracle statements."""
