"""Time-series feature, statistics and forecasting operators for Spark DataFrames."""

__version__ = "0.1.0"
