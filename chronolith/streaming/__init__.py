"""Incremental state: change detection by hash, absence, cursors, streams."""
