"""Registered queries: Spark plans over the driver's tables and their
DuckDB oracle SQL."""
