"""Operators on grids of cells (r, c, value)."""
