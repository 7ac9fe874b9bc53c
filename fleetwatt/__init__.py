"""Spark operators for fleets of hourly energy series.

Every operator takes and returns DataFrames.  A row belongs to one series
(``series_id`` by default) and one naive UTC moment (``timestamp``).
"""

KEY = "series_id"
TIME = "timestamp"
