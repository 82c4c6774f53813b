"""Transaction anomaly analytics on Spark."""
