"""Readers of nested JSON pages and XML or HTML documents."""
