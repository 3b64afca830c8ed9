"""Daily flows laid out by reach: a bucketed table that the indices need not shuffle.

Each bucket is one file, sorted by reach, water year and date. Whether a row outlives the
trim of short end years is stored with it, so that no reader looks for it again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.water_years import mark_short_ends

ORDER = ["reach_id", "water_year", "date"]


def write_daily_store(daily: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Write the days of all reaches as a new table, or anew; rows without a reach id have no place.

    One shuffle and one sort by reach. ``buckets`` is the number of tasks that will read the table;
    a bucket should fit the memory of one (some 20 bytes a row). ``path`` makes the table external.
    """
    days = daily.select("reach_id", "date", "streamflow").where(F.col("reach_id").isNotNull())
    marked = mark_short_ends(days.repartition(buckets, "reach_id"))
    rows = marked.select(*ORDER, "streamflow", (~F.col("short_end")).alias("kept"))
    writer = rows.write.format("parquet").mode("overwrite").bucketBy(buckets, "reach_id").sortBy(*ORDER)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def read_daily_store(spark: SparkSession, table: str) -> DataFrame:
    """``reach_id, water_year, date, streamflow, kept``, known to Spark as bucketed and sorted."""
    # Spark takes the files' order into account only where it is told that it may.
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark.table(table)
