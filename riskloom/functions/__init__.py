"""Column expressions: no scan, no shuffle, no Python per row."""
