"""Layered JSON ingestion on Spark: raw records -> Bronze -> Silver -> Gold."""
