"""Timeline, vector and text analytics on Spark."""
