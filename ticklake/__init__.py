"""Market-tick analytics as Spark DataFrame and Structured Streaming operators."""
