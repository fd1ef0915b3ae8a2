"""Readers: exported grids, workbooks and staging tables."""
