"""PySpark-native preparation of wide survey tables."""

__version__ = "0.1.0"
