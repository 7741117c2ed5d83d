"""Conversions composed of operators."""
