"""Survey field-work analytics on the DataFrame and SQL APIs of Spark."""
