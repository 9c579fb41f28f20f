"""Landing contracts, CSV ingest, test-table adapters and the versioned catalog."""
