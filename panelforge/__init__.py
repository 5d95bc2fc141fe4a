"""PySpark-native engine for auditable data quality and record linkage."""

__version__ = "0.1.0"
