"""Sequence, interval and graph analytics on Spark DataFrames."""
