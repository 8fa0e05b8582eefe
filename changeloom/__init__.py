"""A change-data-capture analytics engine expressed in Spark DataFrames."""

__version__ = "0.1.0"
