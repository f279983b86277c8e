"""Service-desk analytics on Spark DataFrames."""
