"""Registered queries (Spark side) and their SQL oracle (DuckDB side)."""
