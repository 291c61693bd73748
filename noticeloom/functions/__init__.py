"""Column expressions: text and HTML cleaning, value parsing, array helpers."""
