"""Order-risk analytics written as Spark DataFrame, Spark ML and Structured Streaming jobs."""
