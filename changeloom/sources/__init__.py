"""Reading change files, and reading and publishing tables."""
