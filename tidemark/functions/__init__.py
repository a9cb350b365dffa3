"""Column expressions: routing, envelope, conversions, names."""
