"""Column expressions: missing values, text, numbers, join keys."""
