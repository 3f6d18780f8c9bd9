"""Analytics operators written as PySpark DataFrame transformations."""
