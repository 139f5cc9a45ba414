"""Column expressions made of built-in Spark functions."""
