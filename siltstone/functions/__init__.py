"""Column expressions: provenance, correlation."""
