"""School access and representation analytics on Spark DataFrames."""
