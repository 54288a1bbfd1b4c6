"""Column expressions and row codecs."""
