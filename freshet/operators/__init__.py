"""Operators: functions from DataFrame to DataFrame.

Hourly frames hold ``feature_id, time`` and model variables. Daily frames hold
``reach_id, date, streamflow``, one row per reach and day; after the water-year trim
also ``water_year``. A missing flow is null, never NaN. Because ``daily_means`` leaves
at most one row per calendar day, every later per-reach window, sort and list is
bounded by the length of the record in days, whatever the skew of the hourly input.
"""

from pyspark.sql import DataFrame, Window, WindowSpec

ALL_ROWS = (Window.unboundedPreceding, Window.unboundedFollowing)
ROWS_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def by_reach() -> WindowSpec:
    return Window.partitionBy("reach_id")


def reach_order() -> WindowSpec:
    """Date order within a reach.

    Leading with the water year changes nothing in the order, and lets windows per
    reach and per water year share one sort.
    """
    return Window.partitionBy("reach_id").orderBy("water_year", "date")


def year_order() -> WindowSpec:
    return Window.partitionBy("reach_id", "water_year").orderBy("date")


def series_order(frame: DataFrame) -> WindowSpec:
    """Date order per reach, by way of the water year where the frame has been sorted so."""
    return reach_order() if "water_year" in frame.columns else by_reach().orderBy("date")
