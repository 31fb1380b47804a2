"""Retail medallion pipeline on PySpark: landing, bronze, silver, gold, metrics and insights."""
