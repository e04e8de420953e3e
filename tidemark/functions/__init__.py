"""Column -> Column functions. All stay inside Spark's own expressions."""
