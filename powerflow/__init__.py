"""Electricity generation time series on Spark: feeds, quality rules, dimensions and sinks."""

__version__ = "0.1.0"
