"""Software-project activity analytics on Spark DataFrames."""
