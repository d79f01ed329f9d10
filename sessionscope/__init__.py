"""Clickstream session analytics on Spark DataFrames.

Actions are rolled up to one row per session, joined to user attributes,
filtered by an analysis task's parameters and summarised; every step is a
DataFrame transformation, so Catalyst plans each result as a whole.
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
