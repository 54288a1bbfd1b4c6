"""Structured Streaming: bounded drains into Parquet."""
