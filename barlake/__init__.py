"""Spark-native engine for daily price bars and live quotes."""
