"""DataFrame operators: each takes and returns DataFrames and leaves the plan to Spark."""
