"""Recommendation analytics as Spark DataFrame plans."""
