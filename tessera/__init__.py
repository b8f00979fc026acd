"""A PySpark-native engine for linked data, audits, document search and evaluation."""
