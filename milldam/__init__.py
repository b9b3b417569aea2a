"""Spark-first ingestion, normalisation and data-quality engine."""
