"""Operators on feature, span and cell tables."""
