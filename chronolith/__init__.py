"""Temporal relationship analytics on Spark."""
