"""Column expressions and small reusable aggregations."""
