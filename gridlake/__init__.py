"""Lakehouse analytics for electricity-market time series, written as plain Spark jobs."""
