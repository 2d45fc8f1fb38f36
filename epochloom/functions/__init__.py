"""Column functions and schema helpers."""
