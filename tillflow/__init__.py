"""Commerce, subscription and marketing analytics as PySpark DataFrame jobs."""
