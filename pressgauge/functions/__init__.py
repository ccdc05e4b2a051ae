"""Column-level functions built from Spark's own expressions."""
