"""Decoding of stored array blocks: compressors, the Blosc container, and filters.

``decoded_block`` undoes a block's compressor and then its filters, last one first. Each
step takes and gives bytes or an array; what cannot be decoded is a ``ValueError``.
"""

import bz2
import gzip
import lzma
import struct
import zlib

import numpy as np
import pyarrow as pa

# Fixed values of the Blosc container, version 1 and 2.
_HEADER, _HEADER_SIZE = "<BBBBIII", 16  # version, inner version, flags, type size, bytes, block size, stored bytes
_BYTE_SHUFFLED, _COPIED, _BIT_SHUFFLED, _WHOLE_BLOCKS = 1, 2, 4, 16
_MOST_STREAMS, _LEAST_STREAM = 16, 128
_INNER = {0: "blosclz", 1: "lz4", 2: "snappy", 3: "zlib", 4: "zstd"}


def _unzstd(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


def _unlz4(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="lz4_raw", asbytes=True)


def _sized_lz4(data: bytes) -> bytes:
    """A block of raw LZ4 behind its size."""
    return _unlz4(data[4:], struct.unpack_from("<I", data)[0])


_STREAMS = {
    "lz4": _unlz4,
    "snappy": lambda data, size: pa.decompress(data, decompressed_size=size, codec="snappy", asbytes=True),
    "zlib": lambda data, size: zlib.decompress(data),
    "zstd": lambda data, size: _unzstd(data),
}


def unshuffled(data: bytes, width: int) -> bytes:
    """Bytes of whole elements, from all first bytes, all second bytes and so on; a rest stays at the end."""
    count = len(data) // width
    planes = np.frombuffer(data, np.uint8, count * width).reshape(width, count)
    return planes.T.tobytes() + data[count * width :]


def unbitshuffled(data: bytes, width: int) -> bytes:
    """As ``unshuffled`` for bits, lowest first; where the elements are no multiple of eight nothing was moved."""
    count = len(data) // width
    if count % 8:
        return data
    planes = np.frombuffer(data, np.uint8, count * width).reshape(8 * width, count // 8)
    bits = np.unpackbits(planes, axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").tobytes() + data[count * width :]


def unblosc(data: bytes) -> bytes:
    """The content of a Blosc container: a header, the starts of its blocks, and their streams."""
    if len(data) < _HEADER_SIZE:
        raise ValueError("Blosc container without a header")
    version, _, flags, width, size, block_size, stored = struct.unpack_from(_HEADER, data)
    if version not in (1, 2):
        raise ValueError(f"Blosc container of version {version}")
    if stored > len(data):
        raise ValueError(f"Blosc container of {stored} bytes has {len(data)}")
    if flags & _COPIED:
        if len(data) < _HEADER_SIZE + size:
            raise ValueError(f"Blosc container with {size} bytes has {len(data) - _HEADER_SIZE}")
        return data[_HEADER_SIZE : _HEADER_SIZE + size]
    if not size:
        return b""
    inner = _INNER.get(flags >> 5)
    if inner not in _STREAMS:
        raise ValueError(f"compression {inner or flags >> 5!r} inside Blosc is not supported")
    blocks = -(-size // block_size)
    try:
        starts = struct.unpack_from(f"<{blocks}i", data, _HEADER_SIZE)
        return b"".join(
            _blosc_block(data, start, min(block_size, size - i * block_size), block_size, width, flags, _STREAMS[inner])
            for i, start in enumerate(starts)
        )
    except struct.error as error:
        raise ValueError(f"Blosc container ends early: {error}") from error


def _blosc_block(data: bytes, at: int, size: int, full: int, width: int, flags: int, inflate) -> bytes:
    """One block; a full one of small elements may be cut into one stream for each byte of an element."""
    split = not flags & _WHOLE_BLOCKS and width <= _MOST_STREAMS and full // width >= _LEAST_STREAM and size == full
    streams = width if split else 1
    length = size // streams
    parts = []
    for _ in range(streams):
        (stored,) = struct.unpack_from("<i", data, at)
        part = data[at + 4 : at + 4 + stored]
        if stored < 0 or len(part) < stored:
            raise ValueError("Blosc stream ends early")
        parts.append(part if stored == length else inflate(part, length))
        if len(parts[-1]) != length:
            raise ValueError(f"Blosc stream of {length} bytes has {len(parts[-1])}")
        at += 4 + stored
    block = b"".join(parts)
    if flags & _BYTE_SHUFFLED and width > 1:
        return unshuffled(block, width)
    if flags & _BIT_SHUFFLED and size >= width:
        return unbitshuffled(block, width)
    return block


COMPRESSORS = {
    "zlib": zlib.decompress,
    "gzip": gzip.decompress,
    "bz2": bz2.decompress,
    "lzma": lzma.decompress,
    "zstd": _unzstd,
    "lz4": _sized_lz4,
    "blosc": unblosc,
}


def _typed(data, dtype: str) -> np.ndarray:
    return np.frombuffer(data, np.dtype(dtype)) if isinstance(data, (bytes, memoryview)) else data.ravel().view(np.dtype(dtype))


def _undelta(data, settings: dict) -> np.ndarray:
    """Values from their first one and the differences."""
    return np.cumsum(_typed(data, settings.get("astype", settings["dtype"])), dtype=np.dtype(settings["dtype"]))


def _unscaled(data, settings: dict) -> np.ndarray:
    """Values from whole numbers of steps of ``1 / scale`` above ``offset``."""
    steps = _typed(data, settings.get("astype", settings["dtype"]))
    return (steps / settings["scale"] + settings["offset"]).astype(np.dtype(settings["dtype"]))


def _bytes(data) -> bytes:
    return bytes(data) if isinstance(data, (bytes, memoryview)) else data.tobytes()


FILTERS = {
    "shuffle": lambda data, settings: unshuffled(_bytes(data), settings.get("elementsize", 4)),
    "delta": _undelta,
    "fixedscaleoffset": _unscaled,
    "astype": lambda data, settings: _typed(data, settings["encode_dtype"]).astype(np.dtype(settings["decode_dtype"])),
    # What these lost when the block was written is gone.
    "quantize": lambda data, settings: data if settings.get("astype") in (None, settings["dtype"]) else _typed(data, settings["astype"]).astype(np.dtype(settings["dtype"])),
    "bitround": lambda data, settings: data,
    **{name: (lambda data, settings, undo=undo: undo(_bytes(data))) for name, undo in COMPRESSORS.items()},
}


def decoded_block(data: bytes, layout: dict) -> np.ndarray:
    """The cells of a stored block, flat, in the type and order of the array's ``layout``."""
    compressor = layout.get("compressor")
    if compressor is not None:
        if compressor["id"] not in COMPRESSORS:
            raise ValueError(f"compression {compressor['id']!r} is not supported")
        data = COMPRESSORS[compressor["id"]](data)
    for settings in reversed(layout.get("filters") or []):
        if settings["id"] not in FILTERS:
            raise ValueError(f"filter {settings['id']!r} is not supported")
        data = FILTERS[settings["id"]](data, settings)
    return _typed(data, layout["dtype"])
