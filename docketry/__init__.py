"""Spark-native analytics over large collections of structured public documents."""

__version__ = "0.1.0"
