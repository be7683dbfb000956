"""Portfolio and market analytics on Spark DataFrames."""
