"""Operators for training-data pipelines over document, label and embedding tables."""
