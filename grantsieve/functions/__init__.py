"""Column operators: Column in, Column out, built from Spark's own expressions."""
