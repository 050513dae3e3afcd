"""Operators over offer tables."""
