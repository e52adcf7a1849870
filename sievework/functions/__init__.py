"""Column expressions: text, metadata, vectors and answer matching."""
