"""sievework: a Spark-native corpus quality-control engine."""

__version__ = "0.1.0"
