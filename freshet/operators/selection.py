"""Selecting reaches and times by label or by position."""

from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from freshet.session import checkpoint_root

# Values per counting round of ``values_at``: bounds what reaches the driver.
ROUND_BUCKETS = 4096


def select_reaches(rows: DataFrame, ids: list[int], key: str = "feature_id", on_missing: str = "raise") -> DataFrame:
    """Keep the rows of a short list of reaches; the list becomes a scan filter."""
    chosen = rows.where(F.col(key).isin(ids))
    if on_missing == "raise":
        found = {r[0] for r in chosen.select(key).distinct().collect()}
        absent = sorted(set(ids) - found)
        if absent:
            raise KeyError(f"reaches not in the data: {absent[:20]}")
    return chosen


def select_reaches_in(rows: DataFrame, reaches: DataFrame, key: str = "feature_id", on_missing: str = "raise") -> DataFrame:
    """Keep the rows whose reach is in a table of ids of any size (semi-join).

    No broadcast is asked for: Spark takes one when the measured size of the id table
    allows it, and otherwise shuffles with its skew handling.
    """
    ids = reaches.select(key).distinct()
    if on_missing == "raise":
        absent = absent_reaches(rows, ids, key).take(20)
        if absent:
            raise KeyError(f"reaches not in the data: {[r[0] for r in absent]}")
    return rows.join(ids, key, "left_semi")


def absent_reaches(rows: DataFrame, reaches: DataFrame, key: str = "feature_id") -> DataFrame:
    """The wanted ids that no row has, each once; both sides combine before they meet."""
    return reaches.select(key).where(F.col(key).isNotNull()).distinct().join(rows.select(key).distinct(), key, "left_anti")


def _is_time(frame: DataFrame, column: str) -> bool:
    return isinstance(frame.schema[column].dataType, (TimestampType, TimestampNTZType))


def _as_long(frame: DataFrame, column: str) -> Column:
    if _is_time(frame, column):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("long")


def values_at(frame: DataFrame, column: str, positions: list[int]) -> list[int | None]:
    """Distinct values of a column at 0-based positions of their ascending order.

    Counts distinct values in equal-width ranges and descends into the range that
    holds the position, so no task and no driver ever sees the whole ordered list.
    Times count as microseconds. A position past the end gives ``None``.
    """
    values = (
        frame.select(_as_long(frame, column).cast("decimal(20,0)").alias("v"))
        .where(F.col("v").isNotNull())
        .distinct()
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        bounds = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
        return [_value_at(values, int(bounds[0]), int(bounds[1]), p) if p < bounds[2] else None for p in positions]
    finally:
        values.unpersist()


def _value_at(values: DataFrame, low: int, high: int, position: int) -> int:
    while low < high:
        width = -(-(high - low + 1) // ROUND_BUCKETS)
        bucket = F.floor((F.col("v") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
        counts = (
            values.where(F.col("v").between(low, high)).groupBy(bucket.cast("int").alias("b")).count()
        ).collect()
        for b, count in sorted((r[0], r[1]) for r in counts):
            if position < count:
                low, high = low + b * width, min(low + (b + 1) * width - 1, high)
                break
            position -= count
    return low


def _limit(frame: DataFrame, column: str, value: int) -> Column:
    if _is_time(frame, column):
        moment = datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=value)
        text = moment.strftime("%Y-%m-%d %H:%M:%S.%f")
        return F.lit(text).cast(frame.schema[column].dataType)
    return F.lit(value)


def select_positions(rows: DataFrame, column: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """Keep the rows whose ``column`` value stands at positions ``[start, stop)``.

    Positions count the distinct values in ascending order. The two end values are
    looked up first, so the selection itself is a plain range filter that reaches the
    scan. A negative end counts from the back. Rows without a value are left out.
    """
    # A row without a value has no position, whatever the bounds.
    rows = rows.where(F.col(column).isNotNull())
    if start < 0 or (stop is not None and stop < 0):
        size = rows.select(column).where(F.col(column).isNotNull()).distinct().count()
        start = max(start + size, 0) if start < 0 else start
        stop = max(stop + size, 0) if stop is not None and stop < 0 else stop
    wanted = [start] if stop is None else [start, stop]
    if stop is not None and stop <= start:
        return rows.where(F.lit(False))
    if start == 0:
        wanted[0] = None
    found = iter(values_at(rows, column, [p for p in wanted if p is not None]))
    if wanted[0] is not None:
        first = next(found)
        if first is None:
            return rows.where(F.lit(False))
        rows = rows.where(F.col(column) >= _limit(rows, column, first))
    if stop is not None:
        end = next(found)
        if end is not None:
            rows = rows.where(F.col(column) < _limit(rows, column, end))
    return rows


def select(rows: DataFrame, mode: str | None, *, ids: list[int] | None = None, start: int = 0,
           stop: int | None = None, on_missing: str = "raise") -> DataFrame:
    """Selection switch: ``"slice"`` by position, ``"reach_list"`` by label, ``None`` for all."""
    if mode is None:
        return rows
    if mode == "slice":
        return select_positions(rows, "feature_id", start, stop)
    if mode == "reach_list":
        if not ids:
            raise ValueError("a reach list must name reaches")
        return select_reaches(rows, ids, on_missing=on_missing)
    raise ValueError(f"unknown selection mode {mode!r}")


def dense_axis(frame: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Each distinct value of a column with its 0-based position in ascending order, and their number.

    Values are range-partitioned and sorted; a checkpoint pins that layout, so that
    positions stay the same when tasks are repeated. Only one count per partition is
    ever brought together.
    """
    checkpoint_root(frame.sparkSession)
    placed = (
        frame.select(column).where(F.col(column).isNotNull()).distinct()
        .repartitionByRange(column).sortWithinPartitions(column)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
        .select(column, F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(2**33 - 1).alias("_row"))
    )
    sizes = {r["_part"]: r["count"] for r in placed.groupBy("_part").count().collect()}
    starts, total = [], 0
    for part in range(max(sizes, default=0) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    start = F.get(F.expr(f"array({', '.join(f'{s}L' for s in starts)})"), F.col("_part").cast("int"))
    return placed.select(column, (start + F.col("_row")).alias("position")), total


def dense_positions(frame: DataFrame, column: str) -> DataFrame:
    """Each distinct value of a column with its 0-based position in ascending order."""
    return dense_axis(frame, column)[0]
