"""Tidemark: layered event analytics on plain Spark DataFrames."""

__version__ = "0.1.0"
