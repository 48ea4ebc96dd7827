"""Spark-native operators and jobs for financial table processing."""

__version__ = "0.1.0"
