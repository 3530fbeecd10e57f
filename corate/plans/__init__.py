"""Composite reports, registered queries and their DuckDB oracle SQL."""
