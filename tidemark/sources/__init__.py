"""Readers and writers for raw, bronze and published tables."""
