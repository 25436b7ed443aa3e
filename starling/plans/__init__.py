"""Loads, query corpus and experiment grids built from the operators."""
