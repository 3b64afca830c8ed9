"""Water-year tagging and removal of incomplete end years."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.calendar import days_in_year, water_year
from freshet.operators import ALL_ROWS, by_reach, reach_order, year_order


def tag_water_years(daily: DataFrame, starting_month: int = 10) -> DataFrame:
    return daily.withColumn("water_year", water_year(F.col("date"), starting_month))


def _is_short_end() -> Column:
    """First or last year of the reach with fewer rows than days."""
    year = F.col("water_year")
    return year.isin(F.col("_first"), F.col("_last")) & (F.col("_days") < days_in_year(year))


def mark_short_ends(daily: DataFrame, starting_month: int = 10) -> DataFrame:
    """Tag water years, and mark the rows of the first and the last one where they are short.

    A year is short when it has fewer rows than days, nulls counting as rows. All three
    windows run on one shuffle and one sort per reach.
    """
    whole = reach_order().rowsBetween(*ALL_ROWS)
    return (
        tag_water_years(daily, starting_month)
        .withColumns({"_first": F.min("water_year").over(whole), "_last": F.max("water_year").over(whole)})
        .withColumn("_days", F.count(F.lit(1)).over(year_order().rowsBetween(*ALL_ROWS)))
        .select(*daily.columns, "water_year", _is_short_end().alias("short_end"))
    )


def trim_water_years(daily: DataFrame, starting_month: int = 10) -> DataFrame:
    """Tag water years and drop the first and the last one when they are short.

    Short years in between stay, and the new end years are not looked at again.
    """
    return mark_short_ends(daily, starting_month).where(~F.col("short_end")).drop("short_end")


def reach_status(daily: DataFrame, starting_month: int = 10) -> DataFrame:
    """Every reach, and whether its indices can be computed.

    They cannot when no water year is left after the trim, or when a year that is left
    has no flow at all. Works on counts per year, so all reaches stay in view.
    """
    years = tag_water_years(daily, starting_month).groupBy("reach_id", "water_year").agg(
        F.count(F.lit(1)).alias("_days"), F.count("streamflow").alias("_flows")
    )
    ends = years.withColumns(
        {"_first": F.min("water_year").over(by_reach()), "_last": F.max("water_year").over(by_reach())}
    )
    return _computed(ends.withColumn("kept", ~_is_short_end()))


def _computed(years: DataFrame) -> DataFrame:
    fewest = F.min(F.when(F.col("kept"), F.col("_flows")))
    return years.groupBy("reach_id").agg(F.coalesce(fewest > 0, F.lit(False)).alias("computed"))


def marked_status(marked: DataFrame) -> DataFrame:
    """As ``reach_status``, of days with ``water_year`` that a stored mark ``kept`` tells from the short ends."""
    years = marked.groupBy("reach_id", "water_year").agg(F.max("kept").alias("kept"), F.count("streamflow").alias("_flows"))
    return _computed(years)
