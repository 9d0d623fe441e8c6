"""Column expressions and the few result-sized numeric helpers."""
