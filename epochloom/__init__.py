"""Epoch-signal analytics on Spark DataFrames."""
