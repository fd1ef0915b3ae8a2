"""Queries over the star-schema tables, and the SQL each one must agree with."""
