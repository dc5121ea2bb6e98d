"""Column functions: keys, text, casts, JSON."""
