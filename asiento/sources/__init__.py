"""Table schemas and the bundle of input tables."""
