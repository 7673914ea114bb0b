"""Column expressions: casts, flags, file names."""
