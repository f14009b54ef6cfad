"""Check workload: packet table derived from the test data, queries, and oracle SQL."""
