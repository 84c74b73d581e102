"""Spark-native indexing and retrieval for large document corpora."""
