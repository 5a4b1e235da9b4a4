"""tallyspark: customer KPI mart and incremental-load audit as lazy Spark DataFrame plans.

Sub-packages
------------
sources    reading tables, the SQL export, landing / KPI / audit sinks
functions  column-level helpers (date offsets, money in cents, audit text and hash)
operators  DataFrame -> DataFrame operators (anchors, KPI mart, rounding, profile,
           external-id publishing, increments, reconciliation, audit rows)
plans      KPI specifications as data and the registered query catalogue
streaming  the load audit driven incrementally by Structured Streaming
"""

__version__ = "0.1.0"
