"""Writes grids as Zarr files, so that the Zarr source has something to read in checks."""

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.grid import to_chunks
from freshet.schemas import FLOW_VARIABLES
from freshet.sources.zarr import file_system

FILL = -999900.0


#: How an array's blocks are stored unless something else is asked for.
ZLIB = {"compressor": {"id": "zlib", "level": 1}, "filters": None}

_INNER = {
    "lz4": (1, lambda data: pa.compress(data, codec="lz4_raw", asbytes=True)),
    "snappy": (2, lambda data: pa.compress(data, codec="snappy", asbytes=True)),
    "zlib": (3, lambda data: zlib.compress(data, 1)),
    "zstd": (4, lambda data: zstandard.ZstdCompressor(level=1).compress(data)),
}


def shuffled(data: bytes, width: int) -> bytes:
    """All first bytes of the elements, then all second ones, and so on."""
    count = len(data) // width
    return b"".join(data[i : count * width : width] for i in range(width)) + data[count * width :]


def bitshuffled(data: bytes, width: int) -> bytes:
    """All lowest bits of the elements, then all second ones; eight elements at a time."""
    count = len(data) // width
    if count % 8:
        return data
    bits = np.unpackbits(np.frombuffer(data, np.uint8, count * width).reshape(count, width), axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").tobytes() + data[count * width :]


def blosc(data: bytes, width: int, cname: str = "lz4", shuffle: int = 1, block_size: int = 0, split: bool = True) -> bytes:
    """A Blosc container; ``shuffle`` is 0, 1 by bytes or 2 by bits."""
    block_size = min(block_size or 1 << 16, max(len(data), 1))
    code, squeeze = _INNER[cname]
    streams, starts, at = [], [], 16 + 4 * -(-len(data) // block_size)
    for low in range(0, len(data), block_size):
        block = data[low : low + block_size]
        cut = split and width <= 16 and block_size // width >= 128 and len(block) == block_size
        block = shuffled(block, width) if shuffle == 1 and width > 1 else bitshuffled(block, width) if shuffle == 2 else block
        starts.append(at)
        length = len(block) // width if cut else len(block)
        for i in range(0, len(block), length):
            part, small = block[i : i + length], squeeze(block[i : i + length])
            part = small if len(small) < length else part
            streams.append(struct.pack("<i", len(part)) + part)
            at += len(streams[-1])
    flags = {0: 0, 1: 1, 2: 4}[shuffle] | (0 if split else 16) | code << 5
    if at >= 16 + len(data):
        return struct.pack("<BBBBIII", 2, 1, flags | 2, width, len(data), block_size, 16 + len(data)) + data
    return struct.pack("<BBBBIII", 2, 1, flags, width, len(data), block_size, at) + struct.pack(f"<{len(starts)}i", *starts) + b"".join(streams)


def encoded(values: np.ndarray, storage: dict) -> bytes:
    """The bytes of a block under a layout's filters and compressor."""
    values = np.ascontiguousarray(values).ravel()
    for settings in storage.get("filters") or []:
        kind = settings["id"]
        if kind == "delta":
            steps = np.concatenate([values[:1], np.diff(values)])
            values = steps.astype(settings.get("astype", settings["dtype"]))
        elif kind == "fixedscaleoffset":
            steps = np.round((values - settings["offset"]) * settings["scale"])
            values = steps.astype(settings.get("astype", settings["dtype"]))
        else:
            values = np.frombuffer(shuffled(values.tobytes(), settings["elementsize"]), np.uint8)
    compressor, data = storage.get("compressor"), values.tobytes()
    if compressor is None:
        return data
    if compressor["id"] == "blosc":
        return blosc(data, values.itemsize, **{k: v for k, v in compressor.items() if k in ("cname", "shuffle", "block_size", "split")})
    return zlib.compress(data, 1)


def _layout(shape, chunks, dtype, dimensions, storage, **attributes):
    layout = {
        "zarr_format": 2, "shape": shape, "chunks": chunks, "dtype": dtype, "order": "C",
        "fill_value": FILL if dtype == "<f8" else 0, **storage,
    }
    return layout, {"_ARRAY_DIMENSIONS": dimensions, **attributes}


def _write(system: fs.FileSystem, path: str, data: bytes) -> None:
    with system.open_output_stream(path, compression=None) as stream:
        stream.write(data)


def block_files(chunk, names: list[str], time_size: int, feature_size: int, stored) -> Iterator[tuple[str, bytes]]:
    """Name and content of a chunk's files; a coordinate block comes with the first of its chunks alone."""
    t, f = chunk["time_chunk"], chunk["feature_chunk"]
    if f == 0:
        times = np.zeros(time_size, "<i8")
        times[: len(chunk["times"])] = np.array(chunk["times"], "datetime64[us]").astype("<i8") // 60_000_000
        yield f"time/{t}", encoded(times, stored("time"))
    if t == 0:
        ids = np.zeros(feature_size, "<i8")
        ids[: len(chunk["feature_ids"])] = chunk["feature_ids"]
        yield f"feature_id/{f}", encoded(ids, stored("feature_id"))
    for name in names:
        block = np.full((time_size, feature_size), FILL)
        cells = pa.array(chunk[name], pa.float64()).fill_null(FILL).to_numpy()
        block[: len(chunk["times"]), : len(chunk["feature_ids"])] = cells.reshape(
            len(chunk["times"]), len(chunk["feature_ids"])
        )
        yield f"{name}/{t}.{f}", encoded(block, stored(name))


def _chunks(batch: pa.RecordBatch, names: list[str]) -> Iterator[dict]:
    """The chunks of a batch with their lists as Arrow arrays, times as UTC whatever their zone."""
    for i in range(batch.num_rows):
        chunk = {c: batch.column(c)[i].as_py() for c in ("time_chunk", "feature_chunk")}
        lists = {c: batch.column(c)[i].values for c in ("times", "feature_ids", *names)}
        lists["times"] = lists["times"].cast(pa.timestamp("us"))
        yield chunk | lists


def write_grid(rows: DataFrame, path: str, time_size: int, feature_size: int, storage: dict[str, dict] | None = None) -> None:
    """One file per chunk and variable, written by the task that holds the chunk.

    The rows are read once: the lengths of the axes are those of the chunks at their edges.
    ``path`` is a URI or a path that all machines share; ``storage`` has the compressor and
    filters of the arrays that are not to be stored as ``ZLIB``.
    """
    system, root = file_system(path)
    stored = lambda name: (storage or {}).get(name, ZLIB)
    names = [n for n in FLOW_VARIABLES if n in rows.columns]
    for name in [*names, "time", "feature_id"]:
        system.create_dir(f"{root}/{name}", recursive=True)

    def save_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(batch, names):
                for file, data in block_files(chunk, names, time_size, feature_size, stored):
                    _write(system, f"{root}/{file}", data)
                edges = [len(chunk["times"]) * (chunk["feature_chunk"] == 0), len(chunk["feature_ids"]) * (chunk["time_chunk"] == 0)]
                yield pa.RecordBatch.from_pydict({"times": [edges[0]], "features": [edges[1]]})

    saved = to_chunks(rows, time_size, feature_size).mapInArrow(save_chunks, "times long, features long")
    times, features = (n or 0 for n in saved.agg(F.sum("times"), F.sum("features")).first())
    arrays = {
        "time": _layout([times], [time_size], "<i8", ["time"], stored("time"), units="minutes since 1970-01-01 00:00:00"),
        "feature_id": _layout([features], [feature_size], "<i8", ["feature_id"], stored("feature_id")),
    }
    for name in names:
        arrays[name] = _layout(
            [times, features], [time_size, feature_size], "<f8", ["time", "feature_id"], stored(name), _FillValue=FILL
        )
    metadata = {}
    for name, (layout, attributes) in arrays.items():
        metadata[f"{name}/.zarray"], metadata[f"{name}/.zattrs"] = layout, attributes
    _write(system, f"{root}/.zmetadata", json.dumps({"zarr_consolidated_format": 1, "metadata": metadata}).encode())
