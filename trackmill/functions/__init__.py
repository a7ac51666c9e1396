"""Column expressions: distances, times, texts and category codes."""
