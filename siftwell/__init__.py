"""Spark-native dataset curation engine."""

__version__ = "0.1.0"
