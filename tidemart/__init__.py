"""Commerce warehouse pipelines and reports on Spark DataFrames and streams."""
