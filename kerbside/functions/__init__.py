"""Column expressions: no DataFrame, no action, no Python UDF."""
