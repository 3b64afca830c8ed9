"""Start of the flood season from 180-day means on a full daily calendar."""

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from freshet.functions.numeric import round_half_even
from freshet.operators import ALL_ROWS, by_reach, series_order

# Fixed values.
SEASON_DAYS = 180
SEASON_MIN_FLOWS = 150
FIRST_YEAR, LAST_YEAR = 1980, 2021

# Factors of SEASON_DAYS, see ``_sums_ahead``.
STRETCHES = (6, 6, 5)


def calendar_order() -> WindowSpec:
    """Date order that leads with the calendar year, so that the aggregate per year
    reuses the sort of the windows."""
    return by_reach().orderBy("year", "date")


def fill_calendar(daily: DataFrame) -> DataFrame:
    """Add a row with a null flow for every day missing between a reach's first and last.

    Each row expands into itself and the days up to the next row, so there is no
    calendar table and no join, and rows stay where they are.
    """
    following = F.lead("date").over(series_order(daily))
    spread = daily.withColumn("_until", F.coalesce(F.date_sub(following, 1), F.col("date"))).withColumn(
        "_day", F.explode(F.sequence(F.col("date"), F.col("_until")))
    )
    return spread.select(
        "reach_id",
        F.col("_day").alias("date"),
        F.when(F.col("_day") == F.col("date"), F.col("streamflow")).alias("streamflow"),
    )


def _sums_ahead(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Replace columns by their sums over the next ``SEASON_DAYS`` rows, this one included.

    A sliding frame would add up 180 values for every row. Sums of short stretches are
    combined into longer ones instead, some 20 steps per row. Unlike running totals,
    whose rounding depends on what came before, equal stretches give equal sums, so
    ties stay ties. Rows too near the end hold partial sums or null.
    """
    order = calendar_order()
    length, rest = STRETCHES[0], STRETCHES[1:]
    frame = frame.withColumns({c: F.sum(c).over(order.rowsBetween(0, length - 1)) for c in columns})
    for factor in rest:
        parts = {c: [F.col(c), *[F.lead(c, length * k).over(order) for k in range(1, factor)]] for c in columns}
        frame = frame.withColumns({c: sum(p[1:], p[0]) for c, p in parts.items()})
        length *= factor
    return frame


def season_means(daily: DataFrame) -> DataFrame:
    """Mean of the 180 days that start on each date.

    Null with fewer than 150 flows in the window, and on the last 179 dates, where the
    window would run past the record.
    """
    flow = F.col("streamflow")
    days = (
        fill_calendar(daily)
        .withColumn("year", F.year("date"))
        .withColumn("_last", F.max("date").over(calendar_order().rowsBetween(*ALL_ROWS)))
        .withColumns({"_sum": F.coalesce(flow, F.lit(0.0)), "_count": flow.isNotNull().cast("int")})
    )
    complete = (F.col("_count") >= SEASON_MIN_FLOWS) & (F.date_add("date", SEASON_DAYS - 1) <= F.col("_last"))
    return _sums_ahead(days, ["_sum", "_count"]).select(
        "reach_id", "year", "date", F.when(complete, F.col("_sum") / F.col("_count")).alias("season_mean")
    )


def gap_years(means: DataFrame) -> DataFrame:
    """Per reach and calendar year, whether any date lacks a season mean."""
    return means.groupBy("reach_id", "year").agg(
        F.max(F.col("season_mean").isNull()).alias("has_gap")
    )


def season_starts(daily: DataFrame) -> DataFrame:
    """Date of the highest season mean per calendar year; the first date wins a tie.

    Years holding any date without a mean are left out.
    """
    best = F.max(F.struct("season_mean", (-F.unix_date("date")).alias("earliest"), "date"))
    return (
        season_means(daily)
        .groupBy("reach_id", "year")
        .agg(
            F.max(F.col("season_mean").isNull()).alias("has_gap"),
            best.alias("best"),
            F.min("date").alias("first_date"),
        )
        .where(~F.col("has_gap") & F.col("year").between(FIRST_YEAR, LAST_YEAR))
        .select("reach_id", "year", F.col("best.date").alias("start_date"), "first_date")
    )


def _median_day(day: Column) -> Column:
    return round_half_even(F.median(day)).cast("int")


def flood_season_start(daily: DataFrame, empty_year: str = "skip") -> DataFrame:
    """Median day of the year on which the season starts, rounded half to even.

    ``empty_year`` says what a dropped year between two kept ones contributes: nothing
    (``"skip"``), or the day of the first date kept (``"first_date"``), as some pandas
    versions have it.
    """
    starts = season_starts(daily)
    day = F.dayofyear("start_date")
    if empty_year == "skip":
        return starts.groupBy("reach_id").agg(_median_day(day).alias("start_date_flood_season"))
    if empty_year != "first_date":
        raise ValueError(f"unknown empty_year {empty_year!r}")
    years = starts.groupBy("reach_id").agg(
        F.collect_list(F.struct("year", day.alias("day"))).alias("kept"),
        F.min("year").alias("low"),
        F.max("year").alias("high"),
        F.min("first_date").alias("first"),
    )
    empty = F.array_except(F.sequence("low", "high"), F.col("kept.year"))
    days = F.concat(F.col("kept.day"), F.transform(empty, lambda _: F.dayofyear("first")))
    return years.select("reach_id", F.explode(days).alias("day")).groupBy("reach_id").agg(
        _median_day(F.col("day")).alias("start_date_flood_season")
    )
