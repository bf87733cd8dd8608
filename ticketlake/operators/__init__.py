"""DataFrame -> DataFrame operators: cleaning, profiling, upsert, dimensions, facts, metrics."""
