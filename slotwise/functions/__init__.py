"""Column expressions. All stay inside Spark's own functions, but for base58 rendering."""
