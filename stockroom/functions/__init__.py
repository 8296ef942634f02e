"""Column expressions: coercion, naming, scalar helpers."""
