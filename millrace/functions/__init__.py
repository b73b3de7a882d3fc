"""Column expressions: text, URLs, HTML and tokens."""
