"""Schema-checked sinks.

Both tables of a run are partitioned by ``run_id``. A target is a path, or the name of a
table, which is created if needed. ``append`` adds rows; ``overwrite`` replaces all rows of
the one run and touches no other. The ``stage`` functions write the same tables into an
attempt of a run store instead, where they appear together.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from freshet.schemas import INDICES_SCHEMA, RETRO_SCHEMA
from freshet.sources.runs import Attempt, Snapshot
from freshet.sources.zarr import MARK, MARK_SCHEMA

STORED_SCHEMA = StructType(
    [*RETRO_SCHEMA.fields, StructField("run_id", StringType()), StructField("year", IntegerType())]
)
STORED_INDICES_SCHEMA = StructType([*INDICES_SCHEMA.fields, StructField("run_id", StringType())])


def _shaped(frame: DataFrame, schema: StructType, *further: str) -> DataFrame:
    """Columns in schema order and type; a null in a required column is an error."""
    absent = [name for name in schema.names if name not in frame.columns]
    if absent:
        raise ValueError(f"columns missing for this table: {absent}")
    out = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            error = F.raise_error(F.lit(f"{field.name} is required")).cast(field.dataType)
            value = F.when(value.isNull(), error).otherwise(value)
        out.append(value.alias(field.name))
    return frame.select(*out, *further)


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _write_run(frame: DataFrame, target: str, mode: str, run_id: str, partitions: list[str]) -> None:
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"a run id names a folder; {run_id!r} has other characters than letters, digits, _ . -")
    if _is_path(target):
        # The run's folder is written by itself, so an overwrite replaces it whole, with
        # all the partitions that the repeated run no longer has, whatever the session's mode.
        frame.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*partitions).parquet(f"{target.rstrip('/')}/run_id={run_id}")
        return
    spark = frame.sparkSession
    whole = frame.withColumn("run_id", F.lit(run_id)).select(*[c for c in frame.columns if c not in partitions], "run_id", *partitions)
    if not spark.catalog.tableExists(target):
        whole.limit(0).write.format("parquet").partitionBy("run_id", *partitions).saveAsTable(target)
    if mode == "append":
        whole.write.mode("append").format("parquet").partitionBy("run_id", *partitions).saveAsTable(target)
        return
    whole.drop("run_id").createOrReplaceTempView("_run_rows")
    spec = ", ".join([f"run_id = '{run_id}'", *partitions])
    # Statically, so that all partitions of the run go, also those it no longer has.
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({spec}) SELECT * FROM _run_rows")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        spark.catalog.dropTempView("_run_rows")


def _read_run(spark: SparkSession, target: str, schema: StructType, run_id: str | None) -> DataFrame:
    rows = spark.read.schema(schema).parquet(target) if _is_path(target) else spark.table(target)
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)


def write_retrospective(rows: DataFrame, target: str, mode: str = "append", run_id: str = "0") -> None:
    """Write hourly rows, partitioned by run and year; narrow, rows are written where they are."""
    _write_run(_shaped(rows, RETRO_SCHEMA).withColumn("year", F.year("time")), target, mode, run_id, ["year"])


def read_retrospective(spark: SparkSession, target: str, run_id: str | None = None) -> DataFrame:
    """Hourly rows of one run or of all; the run is pruned by folder."""
    return _read_run(spark, target, STORED_SCHEMA, run_id).select(*RETRO_SCHEMA.names)


def write_indices(records: DataFrame, target: str, mode: str = "append", run_id: str = "0") -> None:
    """Write index records, partitioned by run; the reach id is required."""
    _write_run(_shaped(records, INDICES_SCHEMA), target, mode, run_id, [])


def read_indices(spark: SparkSession, target: str, run_id: str | None = None) -> DataFrame:
    """Index records of one run or of all."""
    return _read_run(spark, target, STORED_INDICES_SCHEMA, run_id).select(*INDICES_SCHEMA.names)


#: Staged hours; a row that marks a broken block has no time and so stands in a partition of its own.
_STAGED_SCHEMA = StructType([*RETRO_SCHEMA.fields]).add(MARK, MARK_SCHEMA).add("year", "integer")


def stage_retrospective(rows: DataFrame, attempt: Attempt) -> None:
    """Hourly rows by year, and with them the marks of broken blocks if the rows have any."""
    shaped = _shaped(rows, RETRO_SCHEMA, *[c for c in rows.columns if c == MARK])
    attempt.write("retrospective", shaped.withColumn("year", F.year("time")), "year")


def _hours(staged: DataFrame, *further: str) -> DataFrame:
    return staged.where(F.col(MARK).isNull()).select(*RETRO_SCHEMA.names, *further)


def staged_retrospective(attempt: Attempt) -> DataFrame:
    """Hourly rows of an attempt that is not committed yet."""
    return _hours(attempt.read("retrospective", _STAGED_SCHEMA))


def stage_broken_blocks(attempt: Attempt) -> None:
    """The table of broken blocks, from the marks among the attempt's hourly rows."""
    marks = attempt.read("retrospective", _STAGED_SCHEMA).where(F.col("year").isNull() & F.col(MARK).isNotNull())
    attempt.write("broken_blocks", marks.select(f"{MARK}.*"))


def stage_indices(records: DataFrame, attempt: Attempt) -> None:
    attempt.write("indices", _shaped(records, INDICES_SCHEMA))


def retrospective_of(snapshot: Snapshot, run_id: str | None = None) -> DataFrame:
    """Hourly rows of one run or of all, with ``run_id``."""
    return _hours(snapshot.read("retrospective", _STAGED_SCHEMA, run_id), "run_id")


def indices_of(snapshot: Snapshot, run_id: str | None = None) -> DataFrame:
    """Index records of one run or of all, with ``run_id``."""
    return snapshot.read("indices", INDICES_SCHEMA, run_id)


def broken_blocks_of(snapshot: Snapshot, run_id: str | None = None) -> DataFrame:
    """Place and reason of the blocks that runs with marks could not read, with ``run_id``."""
    return snapshot.read("broken_blocks", MARK_SCHEMA, run_id)


def write_text(records: DataFrame, path: str, shards: int | None = None, fmt: str = "json", mode: str = "append") -> None:
    """Write text files, by default one per partition.

    ``shards`` redistributes to that many files. CSV cannot hold lists; use JSON.
    """
    frame = records if shards is None else records.repartition(shards)
    writer = frame.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
