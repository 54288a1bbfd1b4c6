"""Relational steps: clean, key rule, dedupe, star schema, top-N."""
