"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are sets of hashed word shingles. An item of ``q`` distinct shingles is contained at
threshold ``t`` if the document has at least ``ceil(t * q)`` of them, so it lacks at most
``q - ceil(t * q)``. Items are partitioned by size; a partition's sketch holds, of each item,
its ``q - ceil(t * q) + 1`` least shingle hashes (the minima of one random order). A document
that contains the item must have one of them: the containment search of a small set's
MinHash values in a large set misses nothing, however long the document, which banding
on the Jaccard similarity would, as that goes to zero with the length. A document with fewer
shingles than a partition's items need skips the partition. Candidates are then
verified by counting their shingles, as strings. An item of fewer words than a shingle is one
shingle of its own width, and is sought among the document's shingles of that width.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import Vocabulary, materialized, rows_of, utf8

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Characters of benchmark text searched in one pass over the documents; more items take more passes, one after the other.
BLOCK_CHARACTERS = 64_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 20


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).lower().split()


def shingles(words: list[bytes], width: int = SHINGLE_WORDS) -> set[bytes]:
    """Distinct shingles, space-joined; of fewer words the whole sequence, of none nothing."""
    if not words:
        return set()
    width = min(width, len(words))
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def shingle_hashes(words: list[bytes], vocabulary: Vocabulary, width: int = SHINGLE_WORDS) -> np.ndarray:
    """A 64-bit hash of every shingle, in order."""
    hashes = vocabulary.hashes(vocabulary.numbers(words))
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MULTIPLIER + hashes[i : i + n]
    return (mixed ^ (mixed >> np.uint64(29))) * _MULTIPLIER


@dataclass(frozen=True)
class Partition:
    """Items of a shingle width and size class: sorted sketch hashes, the item of each, and the least shingles a document needs."""

    width: int
    needed: int
    sketch: np.ndarray
    owners: np.ndarray


@dataclass(frozen=True)
class Index:
    """Sketches of a block of items, by size class; all shingles of each, for the verification."""

    ids: list
    shingles: list[frozenset[bytes]]
    needed: list[int]
    partitions: list[Partition]
    seen: np.ndarray

    def search(self, text: str | None, vocabulary: Vocabulary) -> Iterator[tuple[int, int]]:
        """Position of every item the text contains, and the number of shared shingles."""
        words = words_of(text)
        found, hashed = set(), {}
        for part in self.partitions:
            if len(words) < part.width or len(words) - part.width + 1 < part.needed:
                continue
            if part.width not in hashed:
                hashes = shingle_hashes(words, vocabulary, part.width)
                hashed[part.width] = np.unique(hashes[self.seen[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]])
            hashes = hashed[part.width]
            if not len(hashes):
                continue
            left, right = (np.searchsorted(part.sketch, hashes, side) for side in ("left", "right"))
            for a, b in zip(left[left < right], right[left < right], strict=True):
                found.update((item, part.width) for item in part.owners[a:b].tolist())
        own = {}
        for item, width in sorted(found):
            if width not in own:
                own[width] = shingles(words, width)
            shared = len(self.shingles[item] & own[width])
            if shared >= self.needed[item]:
                yield item, shared


def build_index(items: list[tuple], width: int = SHINGLE_WORDS, containment: float = CONTAINMENT) -> Index:
    vocabulary, classes = Vocabulary(), {}
    ids, sets, needed = [], [], []
    seen = np.zeros(1 << _FILTER_BITS, bool)
    for item_id, text in items:
        words = words_of(text)
        own = frozenset(shingles(words, width))
        if not own:
            continue
        least = math.ceil(containment * len(own) - 1e-9)
        sketch = np.unique(shingle_hashes(words, vocabulary, width))[: len(own) - least + 1]
        seen[(sketch >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        classes.setdefault((min(width, len(words)), len(own).bit_length()), []).append((least, sketch, len(ids)))
        ids.append(item_id)
        sets.append(own)
        needed.append(least)
    partitions = []
    for (own_width, _), members in sorted(classes.items()):
        sketch = np.concatenate([s for _, s, _ in members])
        owners = np.concatenate([np.full(len(s), i) for _, s, i in members])
        order = np.argsort(sketch, kind="stable")
        partitions.append(Partition(own_width, min(least for least, _, _ in members), sketch[order], owners[order]))
    return Index(ids, sets, needed, partitions, seen)


def _blocks(items: DataFrame, characters: int) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size; one block at a time is on the driver."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"] or "")
        if size >= characters:
            yield block
            block, size = [], 0
    if block:
        yield block


_MATCHES = "array<struct<item_id:long,n_shared:long,n_shingles:long>>"
_MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_shingles", pa.int64())]))


def _search(index):
    def search(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, vocabulary = index.value, Vocabulary()
        for array in texts:
            rows = [
                [{"item_id": known.ids[i], "n_shared": n, "n_shingles": len(known.shingles[i])} for i, n in known.search(t.as_py(), vocabulary)]
                for t in array
            ]
            yield pa.array(rows, _MATCH_TYPE)

    return search


def _passes(items: DataFrame, width: int, containment: float, block_characters: int) -> Iterator[tuple[Column, bool]]:
    """For each block of items the column of those that ``text`` contains, and whether there are several blocks.

    A block's index is broadcast when its turn comes and given up after it, so that tasks hold
    one at a time; the driver reads one block's texts ahead.
    """
    context = items.sparkSession.sparkContext
    blocks = _blocks(items, block_characters)
    block, several = next(blocks, None), False
    while block is not None:
        following = next(blocks, None)
        several |= following is not None
        index = context.broadcast(build_index(block, width, containment))
        yield F.arrow_udf(_search(index), _MATCHES).asNondeterministic()("text"), several
        if several:
            index.destroy()
        block = following


def find_leaks(docs: DataFrame, items: DataFrame, width: int = SHINGLE_WORDS, containment: float = CONTAINMENT, block_characters: int = BLOCK_CHARACTERS) -> DataFrame:
    """``doc_id, item_id, n_shared, n_shingles, containment`` for every document that contains an item.

    Words are lower-cased (A-Z) runs without ASCII white space. Null, empty and wordless
    texts contain nothing and items of that kind are contained nowhere; items of fewer
    words than a shingle are one shingle, and are contained where their words follow each
    other. Repeated rows give repeated pairs. ``items(item_id, text)`` is the stated query set.
    """
    parts = []
    for hits, several in _passes(items, width, containment, block_characters):
        rows = docs.select("doc_id", F.explode(hits).alias("hit"))
        parts.append(materialized(rows, "leaks") if several else rows)
    if not parts:
        parts = [docs.select("doc_id", F.explode(F.array().cast(_MATCHES)).alias("hit"))]
    found = reduce(DataFrame.unionByName, parts)
    return found.select("doc_id", "hit.*").withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def without_leaks(docs: DataFrame, items: DataFrame, block_characters: int = BLOCK_CHARACTERS) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as they were; see ``find_leaks``."""
    kept = docs
    for hits, several in _passes(items, SHINGLE_WORDS, CONTAINMENT, block_characters):
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        rows = kept.select(row, hits.alias("hits")).where(F.size("hits") == 0).select("row.*")
        kept = materialized(rows, "kept") if several else rows
    return kept
