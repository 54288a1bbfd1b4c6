"""Readers: CSV files, event streams, bronze Parquet."""
