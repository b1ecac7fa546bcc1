"""Grids from the drawing primitives of document pages, on Spark DataFrames."""
