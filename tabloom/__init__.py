"""Tabular learning on Spark: prepare, fit, score and evaluate with DataFrame jobs."""

__version__ = "0.1.0"
