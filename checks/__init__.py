"""Registered queries (Spark side) and their DuckDB oracles."""
