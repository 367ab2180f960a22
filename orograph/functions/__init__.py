"""Column expressions: areas of interest, map projection, cell values."""
