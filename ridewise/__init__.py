"""ridewise — Spark-native ride-mobility analytics.

Every public job takes DataFrames and returns DataFrames; nothing runs
outside Spark except a bounded handful of boundary values.
"""

__version__ = "0.1.0"
