"""Column expressions; all built-in functions but for entity decoding."""
