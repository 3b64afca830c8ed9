"""Chunked grids: one row per (time, feature) block, and its long form."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from freshet.operators.selection import dense_axis
from freshet.schemas import FLOW_VARIABLES
from freshet.session import scratch_path

# Block size of the production run.
TIME_SIZE, FEATURE_SIZE = 672, 2000

# Coordinates up to this many (some 200 MB as a hash table) go to every executor; longer
# ones are joined by shuffle.
BROADCAST_COORDINATES = 4_000_000


def _variables(frame: DataFrame) -> list[str]:
    return [name for name in FLOW_VARIABLES if name in frame.columns]


def to_chunks(rows: DataFrame, time_size: int = TIME_SIZE, feature_size: int = FEATURE_SIZE) -> DataFrame:
    """Assemble long rows into chunks of at most ``time_size`` x ``feature_size`` cells.

    Chunk columns: ``time_chunk, feature_chunk, times, feature_ids`` and one array per
    variable in row-major (time, feature) order, null where a cell has no row. All blocks
    of the two axes are there, also those without any row, so the cells do not depend on
    the block size. Cells combine before chunks do, so a chunk never gathers more than its
    cells; a repeated cell or one without a coordinate is an error, as a grid has no place
    for it.
    """
    names = _variables(rows)
    placed = lambda name: F.coalesce(F.col(name), F.raise_error(F.lit(f"grid cell without {name}")).cast(rows.schema[name].dataType))
    once = lambda name: F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("repeated grid cell"))).otherwise(
        F.first(name)
    )
    located = rows.select(placed("time").alias("time"), placed("feature_id").alias("feature_id"), *names)
    # The input is read once, whatever it costs; both axes and the blocks come from its cells.
    path = scratch_path(rows.sparkSession, "cells")
    located.groupBy("time", "feature_id").agg(*[once(name).alias(name) for name in names]).write.parquet(path)
    cells = rows.sparkSession.read.schema(located.schema).parquet(path)
    times, time_count = dense_axis(cells, "time")
    features, feature_count = dense_axis(cells, "feature_id")
    times, features = times.withColumnRenamed("position", "_t"), features.withColumnRenamed("position", "_f")

    def sized(axis: DataFrame, count: int) -> DataFrame:
        return F.broadcast(axis) if count <= BROADCAST_COORDINATES else axis

    by_time = lambda axis: sized(axis, time_count)
    by_feature = lambda axis: sized(axis, feature_count)

    t, f = F.floor(F.col("_t") / time_size), F.floor(F.col("_f") / feature_size)
    width = F.least(F.lit(feature_size), F.lit(feature_count) - f * feature_size)
    index = (F.col("_t") % time_size * width + F.col("_f") % feature_size).cast("int")
    bodies = (
        cells.join(by_feature(features), "feature_id").join(by_time(times), "time")
        .select(t.alias("time_chunk"), f.alias("feature_chunk"), F.struct(index.alias("_i"), *names).alias("_cell"))
        .groupBy("time_chunk", "feature_chunk")
        .agg(F.sort_array(F.collect_list("_cell")).alias("_cells"))
    )
    coordinate = lambda frame, column, at, chunk, out: frame.groupBy(chunk).agg(
        F.sort_array(F.collect_list(F.struct(at, column))).getField(column).alias(out)
    )
    time_axis = coordinate(times, "time", "_t", t.alias("time_chunk"), "times")
    feature_axis = coordinate(features, "feature_id", "_f", f.alias("feature_chunk"), "feature_ids")
    last_feature = (max(feature_count, 1) - 1) // feature_size
    every = time_axis.withColumn("feature_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last_feature).cast("long"))))
    whole = every.join(by_feature(feature_axis), "feature_chunk").join(bodies, ["time_chunk", "feature_chunk"], "left")
    size = F.size("times") * F.size("feature_ids")
    return whole.select(
        "time_chunk", "feature_chunk", "times", "feature_ids",
        *[_dense(F.col("_cells"), name, size, rows.schema[name].dataType).alias(name) for name in names],
    )


def _dense(cells: Column, name: str, size: Column, kind) -> Column:
    """Values at their cell index, the cells in between filled with null."""
    gap = lambda count: F.array_repeat(F.lit(None).cast(kind), count.cast("int"))
    following = lambda at: F.coalesce(F.get(cells, at + 1).getField("_i"), size)
    spread = F.transform(
        cells,
        lambda cell, at: F.concat(F.array(cell[name]), gap(following(at) - cell["_i"] - 1)),
    )
    filled = F.concat(gap(F.get(cells, F.lit(0)).getField("_i")), F.flatten(spread))
    return F.coalesce(filled, gap(size))


def _lists(column: pa.ListArray, i: int) -> pa.Array:
    return column.slice(i, 1).flatten()


def _as_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _cells(rows: np.ndarray, columns: np.ndarray, width: int) -> np.ndarray:
    """Places of a rectangle's cells in a row-major array of this width."""
    return (rows[:, None] * width + columns).ravel()


def _cut_chunks(names: list[str], source: tuple[int, int], target: tuple[int, int]):
    """Cuts each chunk where the target's blocks end; ``t_at, f_at`` are a piece's places in its block."""

    def spans(start: int, count: int, size: int):
        while count:
            length = min(size - start % size, count)
            yield start // size, start % size, length
            start, count = start + length, count - length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                times, ids = _lists(batch.column("times"), i), _lists(batch.column("feature_ids"), i)
                values = [_lists(batch.column(n), i) for n in names]
                place = [batch.column(c)[i].as_py() for c in ("time_chunk", "feature_chunk")]
                wrong = [n for n, v in zip(names, values, strict=True) if len(v) != len(times) * len(ids)]
                if wrong:
                    raise ValueError(f"broken chunk {place[0]}, {place[1]}: {', '.join(wrong)}")
                t_low = 0
                for t_chunk, t_at, t_count in spans(place[0] * source[0], len(times), target[0]):
                    f_low = 0
                    for f_chunk, f_at, f_count in spans(place[1] * source[1], len(ids), target[1]):
                        taken = pa.array(_cells(np.arange(t_low, t_low + t_count), np.arange(f_low, f_low + f_count), len(ids)))
                        yield pa.RecordBatch.from_arrays(
                            [
                                *[pa.array([n], pa.int64()) for n in (t_chunk, f_chunk, t_at, f_at)],
                                _as_list(times.slice(t_low, t_count)),
                                _as_list(ids.slice(f_low, f_count)),
                                *[_as_list(v.take(taken)) for v in values],
                            ],
                            names=["time_chunk", "feature_chunk", "t_at", "f_at", "times", "feature_ids", *names],
                        )
                        f_low += f_count
                    t_low += t_count

    return cut


def _joined_axis(pieces: pa.Table, at: str, coordinate: str) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
    """A block's coordinates from those of its pieces, and where each piece's lie among them."""
    lists = pieces.column(coordinate).combine_chunks()
    starts = pieces.column(at).to_numpy()
    places = [start + np.arange(n) for start, n in zip(starts, lists.value_lengths().to_numpy(), strict=True)]
    every, first = np.unique(np.concatenate(places), return_index=True)
    return lists.flatten().take(pa.array(first)), every, places


def _assemble(names: list[str]):
    """One target chunk from its pieces; cells that no piece has are null."""

    def join(pieces: pa.Table) -> pa.Table:
        times, t_every, t_places = _joined_axis(pieces, "t_at", "times")
        ids, f_every, f_places = _joined_axis(pieces, "f_at", "feature_ids")
        cells = np.concatenate([
            _cells(np.searchsorted(t_every, t), np.searchsorted(f_every, f), len(ids)) for t, f in zip(t_places, f_places, strict=True)
        ])
        if len(np.unique(cells)) < len(cells):
            raise ValueError("repeated grid cell")
        source = np.zeros(len(times) * len(ids), np.int64)
        there = np.zeros(len(source), bool)
        source[cells], there[cells] = np.arange(len(cells)), True
        taken = pa.array(source, mask=~there)
        columns = [pieces.column(c).slice(0, 1).combine_chunks() for c in ("time_chunk", "feature_chunk")]
        columns += [_as_list(times), _as_list(ids)]
        columns += [_as_list(pieces.column(n).combine_chunks().flatten().take(taken)) for n in names]
        return pa.Table.from_arrays(columns, names=["time_chunk", "feature_chunk", "times", "feature_ids", *names])

    return join


def chunk_pieces(chunks: DataFrame, source: tuple[int, int], target: tuple[int, int]) -> DataFrame:
    """What each chunk gives to each target block: one row a piece, narrow, no shuffle."""
    names = _variables(chunks)
    kind = lambda name: chunks.schema[name].dataType.simpleString()
    lists = ", ".join(f"{n} {kind(n)}" for n in ("times", "feature_ids", *names))
    columns = chunks.where(_has_cells()).select("time_chunk", "feature_chunk", "times", "feature_ids", *names)
    places = "time_chunk long, feature_chunk long, t_at long, f_at long"
    return columns.mapInArrow(_cut_chunks(names, source, target), f"{places}, {lists}")


def rechunk(chunks: DataFrame, source: tuple[int, int], target: tuple[int, int] = (TIME_SIZE, FEATURE_SIZE)) -> DataFrame:
    """Chunks of other sizes, made without their long form.

    ``source`` and ``target`` are (time, feature) sizes. Every chunk is cut into the pieces that
    the target's blocks need, the pieces are shuffled, and each block is assembled by their
    offsets. So the shuffle moves one row a piece, and a task holds the pieces of one block.

    A chunk without cells gives nothing. A broken chunk or a cell that two chunks have is an
    error. Cells of a chunk that is not there are null, where other chunks tell their
    coordinates; rows and columns that no chunk tells are left out.
    """
    names = _variables(chunks)
    pieces = chunk_pieces(chunks, source, target)
    kind = lambda name: pieces.schema[name].dataType.simpleString()
    columns = ", ".join(f"{n} {kind(n)}" for n in ("time_chunk", "feature_chunk", "times", "feature_ids", *names))
    return pieces.groupBy("time_chunk", "feature_chunk").applyInArrow(_assemble(names), columns)


def split_chunks(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable chunks and broken ones.

    A chunk is broken when a variable does not hold one value per cell. Chunks without
    cells are neither.
    """
    filled = chunks.where(_has_cells())
    return filled.where(_is_whole(chunks)), filled.where(~_is_whole(chunks))


def _has_cells() -> Column:
    return F.coalesce(F.size("times") * F.size("feature_ids"), F.lit(1)) > 0


def _is_whole(chunks: DataFrame) -> Column:
    size = F.size("times") * F.size("feature_ids")
    whole = F.lit(True)
    for name in _variables(chunks):
        whole = whole & F.coalesce(F.size(name) == size, F.lit(False))
    return F.coalesce(whole, F.lit(False))


def flatten_chunks(chunks: DataFrame, on_bad_chunk: str = "raise", left_out: Observation | None = None) -> DataFrame:
    """Long rows ``feature_id, time, variables`` of all cells; narrow, no shuffle.

    A broken chunk is an error, or is left out with ``on_bad_chunk="skip"``; ``left_out``
    then tells the number of such ``chunks`` once the rows have been computed.
    """
    names = _variables(chunks)
    filled, whole = chunks.where(_has_cells()), _is_whole(chunks)
    if on_bad_chunk == "raise":
        place = F.concat_ws(", ", *[F.col(c).cast("string") for c in ("time_chunk", "feature_chunk") if c in chunks.columns])
        good = filled.where(whole | F.raise_error(F.concat(F.lit("broken chunk "), place)).cast("boolean"))
    elif on_bad_chunk == "skip":
        if left_out is not None:
            filled = filled.observe(left_out, F.count_if(~whole).alias("chunks"))
        good = filled.where(whole)
    else:
        raise ValueError(f"unknown handling of broken chunks {on_bad_chunk!r}")
    exploded = good.select("times", "feature_ids", F.posexplode(F.arrays_zip(*names)).alias("_i", "_cell"))
    width = F.size("feature_ids")
    return exploded.select(
        F.get("feature_ids", F.col("_i") % width).alias("feature_id"),
        F.get("times", F.floor(F.col("_i") / width).cast("int")).alias("time"),
        *[F.col("_cell")[name].alias(name) for name in names],
    )


def grid_summary(rows: DataFrame) -> DataFrame:
    """Dimension sizes, coordinate ranges and missing share per variable, in one row.

    Distinct coordinates are counted through a shuffle on each, never in one task.
    """
    def missing(name: str) -> Column:
        floating = rows.schema[name].dataType.typeName() in ("float", "double")
        return F.col(name).isNull() | F.isnan(name) if floating else F.col(name).isNull()

    shares = [F.avg(missing(name).cast("double")).alias(f"{name}_missing") for name in _variables(rows)]
    return rows.agg(
        F.countDistinct("feature_id").alias("feature_count"),
        F.countDistinct("time").alias("time_count"),
        F.min("feature_id").alias("first_feature"),
        F.max("feature_id").alias("last_feature"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        *shares,
    )
