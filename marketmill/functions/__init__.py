"""Column expressions: parsing, labels, article fields."""
