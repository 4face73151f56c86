"""Spark-native operators for customer and lead data."""
