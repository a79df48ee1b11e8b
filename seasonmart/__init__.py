"""Season analytics on Spark: staging, season tables, metrics and data checks as DataFrames."""
