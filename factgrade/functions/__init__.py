"""Column expressions: text in, value out, no Python on rows."""
