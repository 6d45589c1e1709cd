"""Corpusweave: Spark-native operators for sparse sample-by-feature corpora."""

__version__ = "0.1.0"
