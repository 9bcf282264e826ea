"""Spark-native operators for text corpora and the knowledge graphs built from them."""
