"""Drive-log analytics on Spark DataFrames."""
