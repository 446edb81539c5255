"""Spark-native analytics for large collections of multichannel recordings."""
