"""Operators over the typed tables."""
