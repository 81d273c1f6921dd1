"""Spark-native engine for building topic-centred text corpora."""
