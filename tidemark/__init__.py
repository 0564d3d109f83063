"""Tick, bar and text analytics on the Spark DataFrame API."""
