"""Drift detection, normalisation and loading of parquet file families, on Spark."""
