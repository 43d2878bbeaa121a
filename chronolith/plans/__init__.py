"""Closed semantic plans and their compiler."""
