"""Species-distribution analytics on Spark tables."""
