"""End-to-end plans, look-ups, test-table adapters and the query registry."""
