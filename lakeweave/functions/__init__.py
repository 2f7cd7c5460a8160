"""Column expressions: scalars, predicates and text formats."""
