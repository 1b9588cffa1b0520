"""Operators: every one maps DataFrames to a DataFrame and starts no Spark job."""
