"""Column functions: numbers, text and periods."""
