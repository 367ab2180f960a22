"""Raster files and tile listings as DataFrames, and back."""
