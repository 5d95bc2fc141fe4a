"""PySpark-native data quality and record linkage: functions."""
