"""Layered batch and streaming tables on Spark: ingest, parse, enrich, de-duplicate, version."""
