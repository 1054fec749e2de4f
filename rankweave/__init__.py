"""Ranked retrieval and learning-to-rank analytics as PySpark DataFrame operators."""
