"""Keyed change logs to current tables, as Spark DataFrame and streaming jobs."""
