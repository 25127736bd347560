"""Spark-native preparation, checking and evaluation of recommendation data."""

__version__ = "0.1.0"
