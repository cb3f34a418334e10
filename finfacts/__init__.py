"""Spark-native analytics over quarterly financial-statement filings."""
