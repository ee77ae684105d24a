"""Check queries: every registered query restated as one self-contained DuckDB statement."""
