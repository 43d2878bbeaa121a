"""Operators of a training-data pipeline: mixing, deduplication, scoring, filtering, encoding.

Nothing outside this subpackage imports it; ``queries`` holds what is registered.
"""
