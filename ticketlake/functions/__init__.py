"""Column expressions: time bands and time parts."""
