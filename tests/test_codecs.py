import json
import struct
import zlib

import numpy as np
import pytest

from freshet.sources import codecs, zarr
from tests.test_sources import as_set, grid_rows
from verification.zarr_files import bitshuffled, blosc, encoded, shuffled, write_grid


def test_container_by_hand():
    """Two elements of two bytes, shuffled, as one stored and one zlib stream."""
    content = bytes([1, 10, 2, 20, 3, 30, 4, 40]) * 64  # 256 elements of two bytes
    first, second = content[0::2], content[1::2]
    packed = zlib.compress(second)
    streams = struct.pack("<i", 256) + first + struct.pack("<i", len(packed)) + packed
    header = struct.pack("<BBBBIII", 2, 1, 1 | 3 << 5, 2, 512, 512, 20 + len(streams))
    assert codecs.unblosc(header + struct.pack("<i", 20) + streams) == content


def test_bits_by_hand():
    """Eight elements of a byte: row b holds bit b of all of them."""
    elements = [0b00000001, 0b00000011, 0, 0, 0, 0, 0, 0b10000000]
    rows = [0b00000011, 0b00000010, 0, 0, 0, 0, 0, 0b10000000]
    assert codecs.unbitshuffled(bytes(rows), 1) == bytes(elements) and bitshuffled(bytes(elements), 1) == bytes(rows)
    wide = np.array([1, 256, 3, 0, 0, 0, 0, 1 << 15], "<u2").tobytes()
    slow = [[(value >> bit) & 1 for value in struct.unpack("<8H", wide)] for bit in range(16)]
    packed = bytes(sum(b << i for i, b in enumerate(row)) for row in slow)
    assert bitshuffled(wide, 2) == packed and codecs.unbitshuffled(packed, 2) == wide
    assert codecs.unbitshuffled(b"1234567", 1) == b"1234567"  # seven elements stay as they are


@pytest.mark.parametrize("cname", ["lz4", "zlib", "zstd", "snappy"])
@pytest.mark.parametrize("shuffle", [0, 1, 2])
@pytest.mark.parametrize("split", [True, False])
def test_containers_of_all_kinds(cname, shuffle, split):
    rng = np.random.default_rng(3)
    for width, count in ((1, 5000), (2, 4099), (4, 70_000), (8, 3000), (8, 1), (24, 900), (8, 0)):
        smooth = np.cumsum(rng.integers(0, 3, count * width)).astype("<u1").tobytes()
        noise = rng.integers(0, 256, count * width, np.uint8).tobytes()
        for content in (smooth, noise, bytes(count * width)):
            for block_size in (0, 1 << 10, 5000 // width * width):
                assert codecs.unblosc(blosc(content, width, cname, shuffle, block_size, split)) == content


def test_broken_and_unknown_containers():
    whole = blosc(bytes(range(100)) * 200, 8, "zlib", 1)
    for cut in (5, 17, len(whole) // 2, len(whole) - 1):
        with pytest.raises(ValueError):
            codecs.unblosc(whole[:cut])
    plain = blosc(np.random.default_rng(1).bytes(999), 1)
    assert plain[2] & 2
    with pytest.raises(ValueError, match="bytes has"):
        codecs.unblosc(plain[:-1])
    old = bytearray(whole)
    old[2] &= 31  # the inner code of another compressor
    with pytest.raises(ValueError, match="blosclz"):
        codecs.unblosc(bytes(old))
    with pytest.raises(ValueError, match="version"):
        codecs.unblosc(b"\x09" + whole[1:])


def test_filters_undo_each_other_in_reverse():
    values = np.array([5, 3, 3, 100, -7], "<i8")
    delta = {"id": "delta", "dtype": "<i8", "astype": "<i2"}
    layout = {"dtype": "<i8", "compressor": {"id": "blosc", "cname": "zstd", "shuffle": 2}, "filters": [delta, {"id": "shuffle", "elementsize": 2}]}
    assert codecs.decoded_block(encoded(values, layout), layout).tolist() == values.tolist()
    stored = np.array([5, -2, 0, 97, -107], "<i2")
    assert codecs.decoded_block(stored.tobytes(), {"dtype": "<i8", "filters": [delta]}).tolist() == values.tolist()
    scaled = {"id": "fixedscaleoffset", "dtype": "<f8", "astype": "<i2", "scale": 10, "offset": 1}
    assert codecs.decoded_block(np.array([0, 15, -5], "<i2").tobytes(), {"dtype": "<f8", "filters": [scaled]}).tolist() == [1.0, 2.5, 0.5]
    cast = {"id": "astype", "encode_dtype": "<i2", "decode_dtype": "<f4"}
    assert codecs.decoded_block(np.array([1, 2], "<i2").tobytes(), {"dtype": "<f4", "filters": [cast]}).tolist() == [1.0, 2.0]
    assert shuffled(b"ababab", 2) == b"aaabbb" and codecs.unshuffled(b"aaabbbc", 2) == b"abababc"


@pytest.mark.parametrize("storage", [{"dtype": "<i8", "compressor": {"id": "other"}}, {"dtype": "<i8", "filters": [{"id": "other"}]}])
def test_unknown_steps(storage):
    with pytest.raises(ValueError, match="'other' is not supported"):
        codecs.decoded_block(bytes(8), storage)


def test_sized_lz4_and_plain_blocks():
    import pyarrow as pa

    content = b"abcd" * 100
    data = struct.pack("<I", 400) + pa.compress(content, codec="lz4_raw", asbytes=True)
    assert codecs.decoded_block(data, {"dtype": "|u1", "compressor": {"id": "lz4"}}).tobytes() == content
    assert codecs.decoded_block(content, {"dtype": "|u1"}).tobytes() == content


def test_store_of_containers_equals_its_rows(spark, tmp_path):
    path = str(tmp_path / "grid.zarr")
    storage = {
        "streamflow": {"compressor": {"id": "blosc", "cname": "lz4", "shuffle": 1}, "filters": None},
        "velocity": {"compressor": {"id": "blosc", "cname": "zstd", "shuffle": 2}, "filters": [{"id": "shuffle", "elementsize": 8}]},
        "time": {"compressor": {"id": "blosc", "cname": "snappy", "shuffle": 0}, "filters": [{"id": "delta", "dtype": "<i8"}]},
    }
    write_grid(grid_rows(spark), path, 4, 3, storage)
    zarr.register(spark)
    frame = spark.read.format("zarr_grid").load(path)
    assert as_set(frame) == as_set(grid_rows(spark))
    layout = json.loads((tmp_path / "grid.zarr" / ".zmetadata").read_text())["metadata"]["streamflow/.zarray"]
    assert layout["compressor"]["id"] == "blosc"
