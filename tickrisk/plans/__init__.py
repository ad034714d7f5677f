"""Job plans: the batch job, materialisation, stand-in inputs, the registered
queries and their DuckDB oracle SQL."""
