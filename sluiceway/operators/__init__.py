"""Transformations on one or two DataFrames."""
