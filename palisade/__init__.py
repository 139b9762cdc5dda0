"""palisade: security analytics on Spark DataFrames.

User-activity logs become labelled user-day tables, network-flow tables are
profiled, scaled, split and scored, and the scores are monitored, all as lazy
``DataFrame -> DataFrame`` functions plus a few Structured Streaming jobs.
"""
