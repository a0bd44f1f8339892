"""Composite pipelines, the query registry and the DuckDB oracles."""
