"""Operators for preparing training text at scale, on Spark DataFrames."""
