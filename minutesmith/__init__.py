"""Spark-native analytics for public legislative records."""
