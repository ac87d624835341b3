"""Metadata-driven survey production on Spark DataFrames."""

__version__ = "0.1.0"
