"""Spark-native quality checks for daily market price bars."""
