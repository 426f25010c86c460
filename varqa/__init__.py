"""Spark-first corpus analytics."""
