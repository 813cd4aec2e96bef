"""larkspur: text-to-frames analytics on Spark DataFrames."""
