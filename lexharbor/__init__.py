"""A PySpark-native engine for bibliographic and text corpora."""
