"""gridcube: gridded daily time series as Spark DataFrames."""

__version__ = "0.1.0"
