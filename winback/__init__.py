"""Customer win-back analytics on Spark DataFrames."""
