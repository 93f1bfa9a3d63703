"""End-to-end pipelines: ingest, facts, features, model."""
