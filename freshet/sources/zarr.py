"""Zarr v2 grids in shared folders or object stores as a Spark data source.

``spark.read.format("zarr_grid").load(path)`` gives long rows ``feature_id, time,
variables``. Tasks read whole storage blocks of the variables of the schema, so name those
that are needed with the option ``variables``. The driver reads the metadata, and the
coordinates where there are filters on them: blocks outside are not read at all. What
blocks are stored as is in ``codecs``. A variable's block without a file holds fill
values; a missing coordinate block or array is an error.
"""

import itertools
import json
import logging
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DateType, DoubleType, LongType, StructField, StructType, TimestampNTZType

from freshet.sources.codecs import decoded_block

DIMENSIONS = ("time", "feature_id")
ROWS_PER_BATCH = 65_536
# Small blocks go to tasks together: so many cells and blocks a task at most, and so many tasks at least.
CELLS_PER_TASK, MOST_BLOCKS_PER_TASK, LEAST_TASKS = 1_000_000, 1024, 64
# Rows of small blocks leave Python together, in batches of about this size.
BATCH_BYTES = 2 << 20
UNIT_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or plain path, and the path on it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    return fs.LocalFileSystem(), path


def _content(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_stream(path, compression=None) as stream:
        return stream.read()


@dataclass
class GridArray:
    """One array of the store: its place, layout, attributes and block files."""

    store: str
    name: str
    layout: dict
    attributes: dict

    @property
    def shape(self) -> tuple[int, ...]:
        return tuple(self.layout["shape"])

    @property
    def blocks(self) -> tuple[int, ...]:
        return tuple(self.layout["chunks"])

    @property
    def dimensions(self) -> tuple[str, ...]:
        return tuple(self.attributes.get("_ARRAY_DIMENSIONS", ()))

    def _absent(self, system: fs.FileSystem, folder: str, block: str) -> np.ndarray:
        """What stands for a block without a file; only a variable in a readable store may lack one."""
        if self.name in DIMENSIONS:
            raise FileNotFoundError(f"coordinate block {folder}/{block} is not there")
        if system.get_file_info(folder).type != fs.FileType.Directory:
            raise FileNotFoundError(f"array {folder} is not there")
        fill = self.layout.get("fill_value")
        return np.full(self.blocks, 0 if fill is None else fill).astype(np.dtype(self.layout["dtype"]))

    def _block(self, index: tuple[int, ...]) -> np.ndarray:
        system, root = file_system(self.store)
        folder, block = f"{root}/{self.name}", self.layout.get("dimension_separator", ".").join(map(str, index))
        try:
            data = _content(system, f"{folder}/{block}")
        except FileNotFoundError:
            return self._absent(system, folder, block)
        return decoded_block(data, self.layout).reshape(self.blocks, order=self.layout.get("order", "C"))

    def read(self, *ranges: tuple[int, int]) -> np.ndarray:
        """The cells within ``[start, stop)`` of each dimension, as stored."""
        out = np.empty([stop - start for start, stop in ranges], np.dtype(self.layout["dtype"]))
        touched = [range(start // size, -(-stop // size)) for (start, stop), size in zip(ranges, self.blocks)]
        for index in itertools.product(*touched):
            source, target = [], []
            for at, size, (start, stop) in zip(index, self.blocks, ranges):
                low, high = max(start, at * size), min(stop, (at + 1) * size)
                source.append(slice(low - at * size, high - at * size))
                target.append(slice(low - start, high - start))
            out[tuple(target)] = self._block(index)[tuple(source)]
        return out

    def decoded(self, raw: np.ndarray) -> np.ndarray:
        """Values as doubles: fill numbers to NaN, then scale and offset."""
        values = raw.astype(float)
        for key in ("_FillValue", "missing_value"):
            if key in self.attributes:
                values[raw == np.asarray(self.attributes[key], raw.dtype)] = np.nan
        return values * self.attributes.get("scale_factor", 1.0) + self.attributes.get("add_offset", 0.0)

    def micros(self, start: int, stop: int) -> np.ndarray:
        """Times as microseconds since 1970 from ``<unit>s since <moment>``."""
        unit, origin = re.match(r"(\w+?)s? since (.+)", self.attributes["units"]).groups()
        base = np.datetime64(origin.strip().replace(" ", "T").removesuffix("Z"), "us").astype(np.int64)
        return base + np.round(self.read((start, stop)) * float(UNIT_MICROS[unit])).astype(np.int64)


def open_store(path: str) -> dict[str, GridArray]:
    """All arrays of a store, from its consolidated metadata if there is any."""
    path = path.rstrip("/")
    system, root = file_system(path)
    if system.get_file_info(f"{root}/.zmetadata").type == fs.FileType.File:
        entries = json.loads(_content(system, f"{root}/.zmetadata"))["metadata"]
    else:
        entries = {}
        for folder in system.get_file_info(fs.FileSelector(root)):
            for part in (".zarray", ".zattrs"):
                file = f"{folder.path}/{part}"
                if system.get_file_info(file).type == fs.FileType.File:
                    entries[f"{folder.base_name}/{part}"] = json.loads(_content(system, file))
    names = [key.removesuffix("/.zarray") for key in entries if key.endswith("/.zarray")]
    return {n: GridArray(path, n, entries[f"{n}/.zarray"], entries.get(f"{n}/.zattrs", {})) for n in names}


def grid_sizes(path: str) -> dict[str, int]:
    """Length of each dimension, from the metadata alone."""
    arrays = open_store(path)
    return {name: arrays[name].shape[0] for name in DIMENSIONS}


def _cut(start: int, stop: int, size: int) -> list[tuple[int, int]]:
    edges = [start, *range((start // size + 1) * size, stop, size), stop]
    return [(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def feature_slices(path: str, size: int, start: int = 0, stop: int | None = None) -> list[tuple[int, int]]:
    """Positions ``[start, stop)`` of the reach axis cut at multiples of ``size``, so that whole blocks stay whole."""
    return _cut(*slice(start, stop).indices(grid_sizes(path)["feature_id"])[:2], size)


def check_reaches(path: str, ids: list[int]) -> None:
    """Raises ``KeyError`` for reaches that the grid lacks; reads the reach coordinate and no cell."""
    axis = open_store(path)["feature_id"]
    absent = sorted(set(ids) - set(axis.read((0, axis.shape[0])).tolist()))
    if absent:
        raise KeyError(f"reaches not in the data: {absent[:20]}")


@dataclass
class GridBlock:
    """A range of times and a range of features."""

    times: tuple[int, int]
    features: tuple[int, int]


@dataclass
class GridBlocks(InputPartition):
    """Blocks that one task reads one after the other, as ranges of times and of features."""

    spans: list[tuple[tuple[int, int], tuple[int, int]]]

    def blocks(self) -> Iterator[GridBlock]:
        return itertools.starmap(GridBlock, self.spans)


def _tasks(spans: Iterable[tuple[tuple[int, int], tuple[int, int]]], count: int, cells: int) -> list[GridBlocks]:
    """Neighbouring blocks together, ``count`` blocks of up to ``cells`` cells; one empty task where there are none."""
    together = max(1, min(CELLS_PER_TASK // max(cells, 1), MOST_BLOCKS_PER_TASK, -(-count // LEAST_TASKS)))
    spans = iter(spans)
    return [GridBlocks(part) for part in iter(lambda: list(itertools.islice(spans, together)), [])] or [GridBlocks([])]


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BATCH_BYTES``; larger ones stay as they are."""
    held, size = [], 0
    for batch in batches:
        if held and (size + batch.nbytes > BATCH_BYTES or batch.schema != held[0].schema):
            yield held[0] if len(held) == 1 else pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield held[0] if len(held) == 1 else pa.concat_batches(held)


def _stored(value) -> int:
    """A filter's value as the coordinates hold it: times in microseconds."""
    if isinstance(value, datetime):
        return round((value.replace(tzinfo=value.tzinfo or timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))
    return value


class ZarrGridReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.arrays = open_store(options["path"])
        self.layout = _layout(options)
        if self.layout == "rows":
            self.names = [name for name in schema.names if name not in (*DIMENSIONS, MARK)]
        else:
            self.names = [] if self.layout == "axis" else _variables(self.arrays, options)
        self.schema = schema
        self.options = options
        self.kept = []

    def pushFilters(self, filters):
        """Comparisons of the coordinates are tried before any variable is read."""
        comparisons = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
        for candidate in filters:
            if isinstance(candidate, comparisons) and candidate.attribute in (("feature_id",), ("time",)):
                self.kept.append(candidate)
            yield candidate

    def _span(self, dimension: str) -> tuple[int, int]:
        size = self.arrays[dimension].shape[0]
        prefix = dimension.split("_")[0]
        bounds = slice(int(self.options.get(f"{prefix}_start", 0)), int(self.options.get(f"{prefix}_stop", size)))
        start, stop, _ = bounds.indices(size)
        return start, max(start, stop)

    def _sizes(self) -> dict[str, int]:
        """Storage blocks of the variables along each dimension."""
        first = self.arrays[(self.names or _variables(self.arrays, {}))[0]]
        return dict(zip(first.dimensions, first.blocks))

    def _planned(self, dimension: str, span: tuple[int, int]) -> bool:
        try:
            return bool(self._wanted(dimension, self._coordinates(dimension, span)).any())
        except Exception:
            # Where broken blocks are no error their tasks tell about them.
            if self.options.get("on_bad_block", "raise") == "raise":
                raise
            return True

    def partitions(self):
        if self.layout == "axis":
            blocks = _cut(*self._span("feature_id"), self.arrays["feature_id"].blocks[0])
            return _tasks((((0, 0), f) for f in blocks), len(blocks), self.arrays["feature_id"].blocks[0])
        block = self._sizes()
        group = int(self.options.get("blocks_per_task", 1))
        times = _cut(*self._span("time"), int(self.options.get("time_size", block["time"])))
        features = _cut(*self._span("feature_id"), int(self.options.get("feature_size", block["feature_id"])) * group)
        if "feature_blocks" in self.options:
            wanted = _numbers(self.options["feature_blocks"])
            size = block["feature_id"]
            features = [(a, b) for a, b in features if any(n in wanted for n in range(a // size, -(-b // size)))]
        if self.kept:
            # Blocks without a wanted coordinate are never planned.
            times = [t for t in times if self._planned("time", t)]
            features = [f for f in features if self._planned("feature_id", f)]
        longest = [max((b - a for a, b in spans), default=0) for spans in (times, features)]
        return _tasks(itertools.product(times, features), len(times) * len(features), longest[0] * longest[1])

    def _coordinates(self, dimension: str, span: tuple[int, int]) -> np.ndarray:
        axis = self.arrays[dimension]
        return axis.micros(*span) if dimension == "time" else axis.read(span).astype(np.int64)

    def _wanted(self, dimension: str, values: np.ndarray) -> np.ndarray:
        keep = np.ones(len(values), bool)
        for test in self.kept:
            if test.attribute != (dimension,):
                continue
            if isinstance(test, In):
                keep &= np.isin(values, [_stored(v) for v in test.value])
                continue
            value = _stored(test.value)
            if isinstance(test, EqualTo):
                keep &= values == value
            elif isinstance(test, GreaterThan):
                keep &= values > value
            elif isinstance(test, GreaterThanOrEqual):
                keep &= values >= value
            elif isinstance(test, LessThan):
                keep &= values < value
            else:
                keep &= values <= value
        return keep

    def _cells(self, partition: GridBlock, known: dict):
        """Reaches, times and the stored cells of each variable, times by reaches; ``known`` has the task's last times."""
        ids = self._coordinates("feature_id", partition.features)
        if partition.times not in known:
            times = self._coordinates("time", partition.times)
            known.clear()
            known[partition.times] = times
        times = known[partition.times]
        keep, hours = self._wanted("feature_id", ids), np.flatnonzero(self._wanted("time", times))
        if not keep.any() or not len(hours):
            return None
        ranges = {"time": partition.times, "feature_id": partition.features}
        stored = []
        for name in self.names:
            array = self.arrays[name]
            cells = array.read(*[ranges[d] for d in array.dimensions])
            stored.append((cells if array.dimensions == DIMENSIONS else cells.T)[hours][:, keep])
        return ids[keep], times[hours], stored

    def read(self, partition: GridBlocks):
        known = {}
        return _merged(itertools.chain.from_iterable(self._read_block(block, known) for block in partition.blocks()))

    def _read_block(self, partition: GridBlock, known: dict):
        if self.layout == "axis":
            ids = self._coordinates("feature_id", partition.features)
            positions = np.arange(*partition.features)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(positions)], names=["feature_id", "position"])
            return
        try:
            cells = self._cells(partition, known)
        except Exception as error:
            handling = self.options.get("on_bad_block", "raise")
            if handling == "mark":
                yield self._mark(partition, error)
            elif handling == "skip":
                logging.getLogger(__name__).exception("block %s is left out", partition)
            else:
                raise
            return
        if cells is None:
            return
        batches = {"rows": self._rows, "chunks": self._chunk, "day_sums": self._day_sums}[self.layout](partition, *cells)
        for columns in batches:
            if MARK in self.schema.names:
                columns[MARK] = pa.nulls(len(columns["feature_id" if self.layout != "chunks" else "times"]), _MARK_TYPE)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def _mark(self, partition: GridBlock, error: Exception) -> pa.RecordBatch:
        """One row that tells the place of a broken block and the reason, all else null."""
        place = dict(zip(("time_start", "time_stop", "feature_start", "feature_stop"), (*partition.times, *partition.features)))
        mark = pa.array([place | {"reason": f"{type(error).__name__}: {error}"}], _MARK_TYPE)
        kinds = to_arrow_schema(self.schema)
        return pa.RecordBatch.from_arrays([mark if f.name == MARK else pa.nulls(1, f.type) for f in kinds], names=kinds.names)

    def _rows(self, partition, ids, times, stored):
        step = max(1, ROWS_PER_BATCH // len(ids))
        for low in range(0, len(times), step):
            part = slice(low, low + step)
            count = len(times[part])
            # Cells stay as stored until their stretch of times is sent.
            yield {
                "feature_id": pa.array(np.tile(ids, count)),
                "time": pa.array(np.repeat(times[part], len(ids)), pa.timestamp("us")),
                **{n: pa.array(self.arrays[n].decoded(v[part]).ravel(), from_pandas=True) for n, v in zip(self.names, stored)},
            }

    def _chunk(self, partition, ids, times, stored):
        sizes = self._sizes()
        lists = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        yield {
            "time_chunk": pa.array([partition.times[0] // int(self.options.get("time_size", sizes["time"]))]),
            "feature_chunk": pa.array([partition.features[0] // int(self.options.get("feature_size", sizes["feature_id"]))]),
            "times": lists(pa.array(times, pa.timestamp("us"))),
            "feature_ids": lists(pa.array(ids)),
            **{n: lists(pa.array(self.arrays[n].decoded(v).ravel(), from_pandas=True)) for n, v in zip(self.names, stored)},
        }

    def _day_sums(self, partition, ids, times, stored):
        """Hours, and of each variable the sum and number of its values, by reach and UTC day."""
        day, order = times // UNIT_MICROS["day"], np.argsort(times, kind="stable")
        days, starts, hours = np.unique(day[order], return_index=True, return_counts=True)
        columns = {
            "feature_id": pa.array(np.tile(ids, len(days))),
            "date": pa.array(np.repeat(days, len(ids)).astype(np.int32), pa.date32()),
            "hours": pa.array(np.repeat(hours, len(ids))),
        }
        for name, cells in zip(self.names, stored):
            values = self.arrays[name].decoded(cells)[order]
            there = ~np.isnan(values)
            columns[f"{name}_sum"] = pa.array(np.add.reduceat(np.where(there, values, 0.0), starts).ravel())
            columns[f"{name}_count"] = pa.array(np.add.reduceat(there.astype(np.int64), starts).ravel())
        yield columns


#: What a reader with ``on_bad_block`` = ``mark`` adds to its rows: the place and reason of a broken block, else null.
MARK = "broken_block"
MARK_SCHEMA = StructType([StructField(f"{d}_{e}", LongType()) for d in ("time", "feature") for e in ("start", "stop")]).add("reason", "string")
_MARK_TYPE = pa.struct([*[(f"{d}_{e}", pa.int64()) for d in ("time", "feature") for e in ("start", "stop")], ("reason", pa.string())])

LAYOUTS = ("rows", "chunks", "day_sums", "axis")


def _layout(options: dict) -> str:
    layout = options.get("layout", "rows")
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}, there are {', '.join(LAYOUTS)}")
    return layout


def _variables(arrays: dict[str, GridArray], options: dict) -> list[str]:
    if "variables" in options:
        return [n.strip() for n in options["variables"].split(",")]
    names = [n for n, a in arrays.items() if sorted(a.dimensions) == sorted(DIMENSIONS)]
    if not names:
        raise ValueError(f"no array of the store spans {' and '.join(DIMENSIONS)}")
    return names


def _ranges(numbers: list[int]) -> str:
    """``0-3,7`` for 0, 1, 2, 3 and 7."""
    out = []
    for n in sorted(numbers):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return ",".join(f"{a}-{b}" if a < b else str(a) for a, b in out)


def _numbers(ranges: str) -> set[int]:
    pairs = [part.partition("-") for part in ranges.split(",") if part]
    return {n for first, dash, last in pairs for n in range(int(first), int(last if dash else first) + 1)}


class ZarrGridSource(DataSource):
    """Options: ``feature_start/stop`` and ``time_start/stop`` (positions), ``variables``,
    ``time_size``, ``feature_size``, ``blocks_per_task``, ``feature_blocks`` (numbers of the
    storage blocks to read along the reaches, as ``0-3,7``), ``on_bad_block`` (``raise``,
    ``skip``, or ``mark``: one row with the place and reason), and ``layout``: ``rows`` of one
    cell each, ``chunks`` of one block each, ``day_sums`` of one reach and day of a block, or
    ``axis``, the positions of the reaches without any variable."""

    @classmethod
    def name(cls):
        return "zarr_grid"

    def schema(self):
        layout = _layout(self.options)
        if layout == "axis":
            return StructType([StructField("feature_id", LongType()), StructField("position", LongType())])
        names = _variables(open_store(self.options["path"]), self.options)
        reach, time = StructField("feature_id", LongType()), StructField("time", TimestampNTZType())
        if layout == "rows":
            fields = [reach, time, *[StructField(n, DoubleType()) for n in names]]
        elif layout == "chunks":
            fields = [StructField("time_chunk", LongType()), StructField("feature_chunk", LongType())]
            fields += [StructField("times", ArrayType(time.dataType)), StructField("feature_ids", ArrayType(reach.dataType))]
            fields += [StructField(n, ArrayType(DoubleType())) for n in names]
        else:
            fields = [reach, StructField("date", DateType()), StructField("hours", LongType())]
            fields += [f for n in names for f in (StructField(f"{n}_sum", DoubleType()), StructField(f"{n}_count", LongType()))]
        if self.options.get("on_bad_block") == "mark":
            fields.append(StructField(MARK, MARK_SCHEMA))
        return StructType(fields)

    def reader(self, schema):
        return ZarrGridReader(self.options, schema)


def split_broken(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of a grid read with ``on_bad_block`` = ``mark``, and its broken blocks: place and reason.

    Each of the two reads the grid; write the whole frame first where it is large.
    """
    return frame.where(F.col(MARK).isNull()).drop(MARK), frame.where(F.col(MARK).isNotNull()).select(f"{MARK}.*")


def read_reaches_in(spark: SparkSession, path: str, reaches: DataFrame, key: str = "feature_id", on_missing: str = "raise", **options) -> DataFrame:
    """The grid's rows of the reaches in a table of any size; blocks without any of them are not read.

    Positions come from a join of the table with the grid's axis, read block by block. The driver
    sees the numbers of the blocks to read, which the grid's own size bounds.
    """
    register(spark)
    grid = spark.read.format("zarr_grid")
    wanted = reaches.select(F.col(key).cast("long").alias("feature_id")).where(F.col("feature_id").isNotNull()).distinct()
    axis = grid.option("layout", "axis").load(path)
    if on_missing == "raise":
        absent = wanted.join(axis, "feature_id", "left_anti").take(20)
        if absent:
            raise KeyError(f"reaches not in the data: {[r[0] for r in absent]}")
    arrays = open_store(path)
    first = arrays[_variables(arrays, options)[0]]
    size = first.blocks[first.dimensions.index("feature_id")]
    block = F.floor(F.col("position") / size).alias("block")
    blocks = [r["block"] for r in axis.join(wanted, "feature_id", "left_semi").select(block).distinct().collect()]
    rows = spark.read.format("zarr_grid").options(**options).option("feature_blocks", _ranges(blocks)).load(path)
    return rows.join(wanted, "feature_id", "left_semi")


def register(spark: SparkSession) -> None:
    """Make the format known and let filters on the coordinates reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZarrGridSource)
