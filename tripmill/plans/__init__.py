"""End-to-end jobs: ingestion, training, scoring, chart tables."""
