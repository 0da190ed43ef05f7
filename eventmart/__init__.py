"""Event-stream and star-schema analytics on Spark DataFrames."""
