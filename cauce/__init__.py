"""cauce: registry-data resolution, ranking and corpus preparation on Spark DataFrames."""
