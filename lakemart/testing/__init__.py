"""Test support: the DuckDB oracle SQL for every checked product."""
