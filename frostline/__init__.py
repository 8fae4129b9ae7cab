"""Spark-first cleaning of sensor time series and climate indices."""

__version__ = "0.1.0"
