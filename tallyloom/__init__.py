"""Market-basket analytics on Spark DataFrames."""
