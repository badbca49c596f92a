"""Vintage features, labels, variable screening and score evaluation on Spark."""

__version__ = "0.1.0"
