"""Readers and writers for price, dimension and weight files."""
