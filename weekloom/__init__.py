"""Weekly sales and marketing analytics on Spark."""
