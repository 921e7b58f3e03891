"""Time-series, interval and event analytics as Spark DataFrame operators."""
