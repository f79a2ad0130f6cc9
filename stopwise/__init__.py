"""Transit operations analytics on Spark DataFrames and Structured Streaming."""
