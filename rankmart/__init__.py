"""rankmart: ranking data that changes over time, as ordinary Spark DataFrames."""
