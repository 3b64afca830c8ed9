"""Packing by power-of-two decomposition of tokenised documents.

A document's ids are cut into pieces whose lengths are powers of two: as many whole
sequences as fit, then the binary digits of the rest. Each piece is a sequence of its own in
the bucket of its length, so no sequence crosses documents and none is padded. Sequences of a
bucket share one length and form batches without attention masks.
"""

import json
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import VOCABULARY_WORDS, rows_of

SEQUENCE = 1024
END_ID = 0

#: A single space between visible characters; byte-level pre-tokenisers always cut before it.
_SAFE_CUT = regex.compile(r"(?<=\S) (?=\S)")
_BATCH_CHARACTERS = 500_000


def _byte_ranks(path: str) -> dict[bytes, int] | None:
    """Byte sequences and ids of a byte-level BPE file whose ids follow the order of its merges; else None."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if model["type"] != "BPE" or spec["normalizer"] or not plain:
        return None
    # Byte-level files write bytes without a visible character as the characters from 256 on.
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merges]
    special = {t["content"] for t in spec["added_tokens"]}
    if ids != sorted(ids):
        return None
    return {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


class _UnsafeCut(Exception):
    """A space stands beside other white space."""


class _Chunks(dict):
    """Ids, as bytes, of chunks with a space before them."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self._encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _UnsafeCut
        self[chunk] = data = self.pack(" " + chunk)
        return data

    def pack(self, text: str) -> bytes:
        ids = self._encode(text)
        return struct.pack(f"<{len(ids)}I", *ids)


def _added_tokens(path: str) -> dict[str, int]:
    """The file's added tokens, which the tokenizer finds in a text before all else."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    for token in added:
        if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"added token {token['content']!r} takes its surroundings into account, which is not supported")
    return {token["content"]: token["id"] for token in added}


class CachedTokenizer:
    """Ids of whole texts by way of a cache of their space-separated chunks.

    For byte-level tokenisers that attach a space to the word after it. A chunk's ids do not
    depend on its neighbours if single spaces part it from them; texts with any other
    spacing are cut only where that holds. The file's added tokens are cut out first. Chunks not seen before are encoded by tiktoken with
    the file's own vocabulary where its merges are in order of its ids, which gives the same
    ids several times as fast, and by tokenizers otherwise.
    """

    def __init__(self, path: str):
        ranks = _byte_ranks(path)
        if ranks is not None:
            import tiktoken
            from public_tokenizers import PATTERN

            encode = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            encode = lambda chunk: tokenizer.encode(chunk, add_special_tokens=False).ids
        self._ids = _Chunks(encode)
        self._added = _added_tokens(path)
        # The first alternative wins, so longer tokens come before their beginnings.
        longest = sorted(self._added, key=len, reverse=True)
        self._cut_added = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None

    def _plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        first, *others = text.split(" ")
        try:
            if first and (first[0].isspace() or first[-1].isspace()) or not first and others:
                raise _UnsafeCut
            return self._ids.pack(first) + b"".join(map(self._ids.__getitem__, others))
        except _UnsafeCut:
            first, *others = _SAFE_CUT.split(text)
            return b"".join(map(self._ids.pack, [first, *map(" ".__add__, others)]))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:
            if len(self._ids) > VOCABULARY_WORDS:
                self._ids.clear()
            if self._cut_added is not None and self._cut_added.search(text):
                parts = self._cut_added.split(text)
                data = b"".join(struct.pack("<I", self._added[p]) if i % 2 else self._plain(p) for i, p in enumerate(parts))
            else:
                data = self._plain(text)
            yield np.frombuffer(data, "<u4")


def decoder(path: str) -> Callable[[list[int]], str]:
    """The text of ids; by a table of byte sequences where the file is byte-level, else by tokenizers."""
    ranks = _byte_ranks(path)
    if ranks is None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda ids: tokenizer.decode(ids, skip_special_tokens=False)
    table = {i: data for data, i in ranks.items()} | {i: token.encode() for token, i in _added_tokens(path).items()}
    return lambda ids: b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")


def piece_lengths(length: int, sequence: int = SEQUENCE) -> list[int]:
    """Lengths of a document's pieces, longest first: whole sequences, then powers of two."""
    whole, rest = divmod(length, sequence)
    return [sequence] * whole + [1 << bit for bit in reversed(range(sequence.bit_length())) if rest >> bit & 1]


PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _pack(tokenizer_path: str, sequence: int, end_id: int):
    def texts_of(batches):
        """Rows in groups of bounded text, whatever the length of a text."""
        group, size = [], 0
        for batch in batches:
            for row in rows_of(batch, ["doc_id", "text"]):
                group.append((row[0], row[1] or ""))
                size += len(group[-1][1])
                if size >= _BATCH_CHARACTERS:
                    yield group
                    group, size = [], 0
        if group:
            yield group

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = CachedTokenizer(tokenizer_path)
        counters = [0] * sequence.bit_length()
        part = TaskContext.get().partitionId()
        for group in texts_of(batches):
            columns = [[] for _ in range(7)]
            for (doc_id, _), ids in zip(group, tokenizer.encode([t for _, t in group]), strict=True):
                ids = np.append(ids, np.array([end_id], "<u4"))
                start = 0
                for length in piece_lengths(len(ids), sequence):
                    bucket = length.bit_length() - 1
                    # Bucket, task and place in the task: unique, and ordered by length.
                    sequence_id = (bucket << 57) | (part << 34) | counters[bucket]
                    counters[bucket] += 1
                    row = (doc_id, start, length, len(ids), sequence_id, 0, ids[start : start + length].tobytes())
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    start += length
            types = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in PIECES.split(", ")])

    return pack


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of all rows of ``docs(doc_id, text)``, each a sequence of its own.

    ``ids`` are little-endian unsigned 32-bit numbers, the document's ids and then
    ``end_id`` cut at ``start``; ``sequence_id`` sorts by length (its bucket). A null text is
    empty and packs as its end id alone. Tasks need nothing from one another: no shuffle.
    ``sequence`` is a power of two.
    """
    if sequence & sequence - 1:
        raise ValueError("the sequence length must be a power of two")
    return docs.select("doc_id", "text").mapInArrow(_pack(tokenizer_path, sequence, end_id), PIECES)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per length, so that a trainer draws batches of equal sequences."""
    pieces.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
