"""Query plans: the registry of named queries and their DuckDB oracles."""
