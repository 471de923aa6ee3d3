"""Spark-native analytics for text-heavy record corpora."""
