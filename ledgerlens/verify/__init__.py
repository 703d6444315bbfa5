"""Correctness tooling: the DuckDB oracle SQL and a result comparer."""
