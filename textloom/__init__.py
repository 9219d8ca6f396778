"""Full-text search and text analysis over Spark DataFrames."""

__version__ = "0.1.0"
