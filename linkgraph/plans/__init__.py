"""Stages put together, and the queries over the driver's tables."""
