"""lexmill: a PySpark-native engine for literature-corpus analytics."""

__version__ = "0.1.0"
