"""Named queries over a table directory, and their DuckDB oracle SQL."""
