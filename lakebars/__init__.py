"""Hourly time series on Spark: landed files to partitioned bars and means."""
