"""Query registry, SQL surface and the independent DuckDB oracle."""
