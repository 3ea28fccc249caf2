"""Table loads and queries."""
