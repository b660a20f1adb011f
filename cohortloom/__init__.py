"""Cohort analytics on Spark: ingest, scoring, features, evaluation."""

__version__ = "0.1.0"
