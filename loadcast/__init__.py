"""loadcast: hourly load analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers, fixture views and table writers (bronze/silver/gold)
functions  column expressions (calendar, time parsing, statistics)
operators  DataFrame -> DataFrame operators (cleaning, features, models...)
plans      composed jobs and partitioning plans (halo-bucketed windows)
streaming  Structured Streaming twins of the batch operators
"""

__all__ = ["session", "schemas"]
