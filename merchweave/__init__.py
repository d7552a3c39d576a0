"""Retail recommendation analytics on Spark DataFrames."""
