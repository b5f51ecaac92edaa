"""weftline: a PySpark-native engine for posting text, mention tables and their analytics."""

__version__ = "0.1.0"
