"""Incremental load of newly arrived files."""
