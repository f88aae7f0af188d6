"""Batch jobs for environmental sensor time series, built on Spark DataFrames."""
