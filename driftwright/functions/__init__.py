"""Types, casts and name functions as Spark columns."""
