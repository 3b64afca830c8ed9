"""Hydrological frames made from the driver's tables.

``events`` stands in for hourly flows (user = reach), ``lineitem`` for daily flows
1995-01-02 .. 2001-11-04 with return flag, line number or supplier as the reach.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions.calendar import water_year


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("feature_id"), F.col("ts").alias("time"), F.col("value").alias("streamflow")
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per reach and full hour, as a grid has it."""
    rows = hourly(spark, sf_dir)
    return rows.groupBy("feature_id", F.date_trunc("hour", "time").cast("timestamp_ntz").alias("time")).agg(
        F.max("streamflow").alias("streamflow"), F.min("streamflow").alias("velocity")
    )


def hourly_some_unnamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh reach without its id."""
    return hourly(spark, sf_dir).withColumn("feature_id", F.when(F.col("feature_id") % 7 != 0, F.col("feature_id")))


def coarse_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five reaches, some of whose days have all hours and some not."""
    rows = hourly(spark, sf_dir)
    hour = F.date_trunc("hour", "time").cast("timestamp_ntz").alias("time")
    return rows.groupBy((F.col("feature_id") % 5 + 1).alias("feature_id"), hour).agg(F.max("streamflow").alias("streamflow"))


def cells_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with small flows and large velocities missing."""
    kept = {"streamflow": F.col("streamflow") >= 20, "velocity": F.col("velocity") < 150}
    return cells(spark, sf_dir).withColumns({c: F.when(keep, F.col(c)) for c, keep in kept.items()})


def sparse_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few hours of few reaches, so that many blocks of a fine grid have no row."""
    return cells(spark, sf_dir).where((F.hour("time") == F.col("feature_id") % 24) & (F.dayofmonth("time") % 2 == F.col("feature_id") % 2))


def _daily(spark: SparkSession, sf_dir: str, reach: Column) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(reach.cast("long").alias("reach_id"), F.to_date("l_shipdate").alias("date"))
        .agg(F.avg("l_quantity").alias("streamflow"))
    )


def daily_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir, F.ascii("l_returnflag"))


def daily_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir, F.col("l_linenumber"))


def daily_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir, F.col("l_suppkey"))


def _lowered(days: DataFrame, by: float) -> DataFrame:
    return days.withColumn("streamflow", F.greatest(F.col("streamflow") - by, F.lit(0.0)))


def daily_intermittent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lowered(daily_gappy(spark, sf_dir), 25.0)


def daily_rare_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lowered(daily_gappy(spark, sf_dir), 1.5)


def daily_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with a very high mean count as missing."""
    flow = F.col("streamflow")
    return daily_gappy(spark, sf_dir).withColumn("streamflow", F.when(flow <= 40, flow))


def daily_missing_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``daily_missing`` up to 1998-09, complete from then on."""
    flow = F.col("streamflow")
    kept = (flow <= 40) | (F.col("date") >= F.lit("1998-10-01").cast("date"))
    return daily_gappy(spark, sf_dir).withColumn("streamflow", F.when(kept, flow))


def daily_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of six reaches lacks every flow of one water year."""
    blank = water_year(F.col("date")) == F.col("reach_id") + 1995
    return daily_gappy(spark, sf_dir).withColumn("streamflow", F.when(~blank, F.col("streamflow")))


def daily_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 30-row mean with a yearly wave, which has the long recessions noise lacks."""
    month = Window.partitionBy("reach_id").orderBy("date").rowsBetween(-29, 0)
    wave = 10 * F.cos(F.dayofyear("date") * 0.0172)
    return daily_dense(spark, sf_dir).withColumn("streamflow", F.avg("streamflow").over(month) + wave)


def _sql_daily(reach: str) -> str:
    return (
        f"SELECT CAST({reach} AS BIGINT) AS reach_id, CAST(l_shipdate AS DATE) AS date, "
        "avg(l_quantity) AS streamflow FROM lineitem GROUP BY 1, 2"
    )


SQL_VIEWS = {
    "hourly": "SELECT user_id AS feature_id, ts AS time, value AS streamflow FROM events",
    "cells": (
        "SELECT user_id AS feature_id, date_trunc('hour', ts) AS time, "
        "max(value) AS streamflow, min(value) AS velocity FROM events GROUP BY 1, 2"
    ),
    "hourly_some_unnamed": "SELECT CASE WHEN user_id % 7 <> 0 THEN user_id END AS feature_id, ts AS time, value AS streamflow FROM events",
    "daily_single": (
        "SELECT reach_id, date, CAST(CAST(streamflow AS FLOAT) AS DOUBLE) AS streamflow FROM "
        f"({_sql_daily('l_linenumber')})"
    ),
    "coarse_cells": (
        "SELECT user_id % 5 + 1 AS feature_id, date_trunc('hour', ts) AS time, max(value) AS streamflow FROM events GROUP BY 1, 2"
    ),
    "daily_dense": _sql_daily("ascii(l_returnflag)"),
    "daily_gappy": _sql_daily("l_linenumber"),
    "daily_sparse": _sql_daily("l_suppkey"),
    "daily_intermittent": (
        "SELECT reach_id, date, greatest(streamflow - 25, 0) AS streamflow FROM "
        f"({_sql_daily('l_linenumber')})"
    ),
    "daily_rare_zero": (
        "SELECT reach_id, date, greatest(streamflow - 1.5, 0) AS streamflow FROM "
        f"({_sql_daily('l_linenumber')})"
    ),
    "daily_missing_early": (
        "SELECT reach_id, date, CASE WHEN streamflow <= 40 OR date >= DATE '1998-10-01' THEN streamflow END AS streamflow FROM "
        f"({_sql_daily('l_linenumber')})"
    ),
    "cells_missing": (
        "SELECT user_id AS feature_id, date_trunc('hour', ts) AS time, CASE WHEN max(value) >= 20 THEN max(value) END AS streamflow, "
        "CASE WHEN min(value) < 150 THEN min(value) END AS velocity FROM events GROUP BY 1, 2"
    ),
    "sparse_cells": (
        "SELECT user_id AS feature_id, date_trunc('hour', ts) AS time, max(value) AS streamflow, min(value) AS velocity FROM events "
        "WHERE hour(ts) = user_id % 24 AND day(ts) % 2 = user_id % 2 GROUP BY 1, 2"
    ),
    "daily_blank": (
        "SELECT reach_id, date, CASE WHEN year(date) + CASE WHEN month(date) >= 10 THEN 1 ELSE 0 END "
        f"<> reach_id + 1995 THEN streamflow END AS streamflow FROM ({_sql_daily('l_linenumber')})"
    ),
    "daily_smooth": (
        "SELECT reach_id, date, avg(streamflow) OVER (PARTITION BY reach_id ORDER BY date ROWS BETWEEN 29 PRECEDING "
        "AND CURRENT ROW) + 10 * cos(dayofyear(date) * 0.0172) AS streamflow FROM "
        f"({_sql_daily('ascii(l_returnflag)')})"
    ),
    "daily_missing": (
        "SELECT reach_id, date, CASE WHEN streamflow <= 40 THEN streamflow END AS streamflow FROM "
        f"({_sql_daily('l_linenumber')})"
    ),
}
