"""Stream and table analytics on Spark DataFrames."""
