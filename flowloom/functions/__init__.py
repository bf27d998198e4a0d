"""Column expressions: coercion, predicates and network arithmetic."""
