"""Composite plans: clean, summarise, load and publish."""
