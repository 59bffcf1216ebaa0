"""Column expressions: rounding, identifiers, instants, metrics."""
