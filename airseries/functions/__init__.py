"""Column expressions: bands, calendar parts, numeric helpers, label names."""
