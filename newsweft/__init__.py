"""Spark-native engine for ingesting, cleaning, deduplicating, scoring and publishing news articles."""

__version__ = "0.1.0"
