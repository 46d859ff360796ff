"""Uplift feature pipelines as PySpark DataFrame jobs."""
