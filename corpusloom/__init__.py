"""Spark-native operators for building, checking and publishing a knowledge corpus."""
