"""Order-tracking datasets as lazy Spark DataFrames."""
