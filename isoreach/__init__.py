"""isoreach: a PySpark-native engine for spatial accessibility analytics."""

__version__ = "0.1.0"
