"""Cohort-based recommendation over rating facts, as PySpark DataFrame plans."""
