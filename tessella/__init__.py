"""Spark-native sequence, interval and corpus analytics."""
