"""Match analytics on Spark DataFrames."""
