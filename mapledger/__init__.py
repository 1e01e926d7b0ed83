"""Spark-native audit of ETL map metadata."""
