"""Operators: top-1-per-key, calendar spine, data-quality checks, incremental loading."""
