"""Keeps people data in step with a daily full-snapshot feed, on Spark."""
