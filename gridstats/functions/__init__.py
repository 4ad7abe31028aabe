"""Column expressions: lenient parsing and times of day."""
