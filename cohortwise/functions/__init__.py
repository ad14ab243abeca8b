"""Small numeric and column helpers."""
