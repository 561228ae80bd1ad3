"""Spark-native literature analytics: typed documents, passages, versions, alignment."""
