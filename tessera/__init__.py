"""Spark-native curation, enrichment and evaluation analytics."""
