"""Parquet footers, file families and the monthly download."""
