"""The jobs a user runs: ingest, bronze, transform, publish, and all of them in order."""
