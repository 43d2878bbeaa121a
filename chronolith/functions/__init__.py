"""Columns and small DataFrame kits: intervals, text, dates."""
