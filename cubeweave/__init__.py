"""Virtual multi-dimensional datasets as Spark DataFrames."""
