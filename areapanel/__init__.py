"""Area-by-month feature panels on Spark DataFrames."""
