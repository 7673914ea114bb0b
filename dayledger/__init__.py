"""Daily station observations on Spark: land, flag, merge and publish."""
