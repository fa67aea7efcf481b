"""Binding-site analytics on Spark DataFrames."""
