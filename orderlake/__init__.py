"""Order-update analytics on Spark."""
