"""Spark-first analytics for document archives."""
