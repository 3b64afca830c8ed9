"""Hourly rows to daily means, and short heads of hourly series."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from freshet.functions.missing import null_if_nan


def daily_means(hourly: DataFrame, value: str = "streamflow") -> DataFrame:
    """Mean flow per reach and UTC day; a day with any missing hour is missing.

    Counts and sums combine before the shuffle on (reach, day), so a reach that holds
    much of the input still moves only one partial row per day and task. Rows without
    a reach id form one series of their own.
    """
    flow = null_if_nan(F.col(value).cast("double"))
    time = F.col("time")
    if isinstance(hourly.schema["time"].dataType, TimestampType):
        # Days are UTC days, whatever zone the session shows times in.
        time = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_micros(time) / 86_400_000_000).cast("int"))
    return (
        hourly.groupBy(F.col("feature_id").alias("reach_id"), F.to_date(time).alias("date"))
        .agg(F.when(F.count(F.lit(1)) == F.count(flow), F.avg(flow)).alias("streamflow"))
    )


def daily_means_from_sums(sums: DataFrame, value: str = "streamflow") -> DataFrame:
    """As ``daily_means``, from sums by reach and day that a grid reader made inside its blocks.

    ``sums`` has ``feature_id, date, hours`` and the sum and number of the values, one row for each
    reach, day and block (the reader's layout ``day_sums``); a day cut by blocks comes together here.
    """
    total, there, hours = F.sum(f"{value}_sum"), F.sum(f"{value}_count"), F.sum("hours")
    return sums.groupBy(F.col("feature_id").alias("reach_id"), "date").agg(F.when(there == hours, total / there).alias("streamflow"))


def first_rows(hourly: DataFrame, count: int, *tie_breakers: str) -> DataFrame:
    """The first ``count`` rows of every reach in time order.

    Spark cuts each task's rows to ``count`` per reach before they are shuffled.
    """
    order = Window.partitionBy("feature_id").orderBy("time", *tie_breakers)
    ranked = hourly.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= count).drop("_rank")
