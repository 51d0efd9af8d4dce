"""Column expressions: one column in, one column out."""
