"""Query catalog: Spark plans and their DuckDB oracles."""
