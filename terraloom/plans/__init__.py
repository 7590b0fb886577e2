"""Composite workflows built from the operators."""
