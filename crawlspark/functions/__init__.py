"""Column expressions: HTML fragments, URLs, file names, numbers."""
