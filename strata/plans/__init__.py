"""Models (Silver, Gold), analytic queries, the test suite and the full-refresh build."""
