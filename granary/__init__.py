"""Spark jobs that ingest, conform, de-duplicate, reshape and check tabular food data."""
