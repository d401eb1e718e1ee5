"""Speech-and-text curation analytics expressed as Spark DataFrame, SQL and Structured Streaming transforms."""
