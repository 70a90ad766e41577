"""Column expressions: geometry, geography, threshold bands, cleaning."""
