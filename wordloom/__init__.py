"""Corpus preparation and training telemetry as Spark DataFrame operators."""
