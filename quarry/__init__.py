"""Quarry: a PySpark-native analytics engine for technical command references."""

__version__ = "0.1.0"
