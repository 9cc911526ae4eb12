"""Config-driven batch table jobs, expressed as Spark DataFrames and SQL."""
