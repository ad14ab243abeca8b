"""Operators that also run on streaming DataFrames."""
