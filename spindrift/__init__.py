"""Spark-native metadata integration and analytics."""
