"""Column expressions: time parts, keys, cleaning, code formats."""
