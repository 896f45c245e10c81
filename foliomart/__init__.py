"""A publishing sales and operations warehouse built on Spark DataFrames."""
