"""In-memory rows and CSV files of hourly or daily series."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from freshet.schemas import DAILY_SCHEMA, RETRO_SCHEMA


def from_records(spark: SparkSession, records: list[dict], schema: StructType = RETRO_SCHEMA) -> DataFrame:
    """A small frame from row dicts; absent fields are null."""
    return spark.createDataFrame([tuple(r.get(name) for name in schema.names) for r in records], schema)


def _read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Read by column name as text and cast, so a leading index column is ignored.

    Each file's own header counts. Where all files have one header, as is usual, they are read by
    the given path; else they are grouped by their header lines, of which there are few,
    however many the files are, and every group is read with its own.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    heads = lines.where("at = 0").groupBy("file").agg(F.first("value").alias("head"))
    headers = [r["head"] for r in heads.select("head").distinct().orderBy("head").collect()]
    groups = {header: path for header in headers}
    if len(headers) > 1:
        groups = {header: [] for header in headers}
        for row in heads.toLocalIterator():
            groups[row["head"]].append(row["file"])
    frames = []
    for files in groups.values():
        text = spark.read.option("header", True).option("enforceSchema", False).csv(files)
        columns = [
            (F.col(f.name).cast(f.dataType) if f.name in text.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
        frames.append(text.select(*columns))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def read_hourly_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _read_csv(spark, path, RETRO_SCHEMA)


def read_daily_csv(spark: SparkSession, path: str | list[str], reach_id: int | None = None) -> DataFrame:
    """Daily series; a file without a reach column belongs to ``reach_id``."""
    days = _read_csv(spark, path, DAILY_SCHEMA)
    return days if reach_id is None else days.withColumn("reach_id", F.lit(reach_id).cast("long"))
