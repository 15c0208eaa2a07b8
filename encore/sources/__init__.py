"""Table schemas, and reading and writing by name."""
