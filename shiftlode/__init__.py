"""Daily operations analytics written as plain PySpark DataFrame operators."""
