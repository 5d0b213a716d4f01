"""Market price and weather analytics on PySpark."""
