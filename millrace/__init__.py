"""Millrace: a Spark-native engine that turns raw text into instruction-tuning data."""

__version__ = "0.1.0"
