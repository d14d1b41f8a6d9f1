"""Departure-procedure analytics on Spark: DataFrames in, DataFrames out."""
