"""Column expressions: text rules and robust numeric helpers."""
