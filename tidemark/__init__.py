"""Table loading and change merging on Spark DataFrames."""

__version__ = "0.1.0"
