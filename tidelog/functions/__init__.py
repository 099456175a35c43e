"""Column expressions: JSON images, SQL text, clock and epoch helpers."""
