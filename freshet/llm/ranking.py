"""Ranked lexical search: all documents against a stated set of items, by blocked matrix products.

Items go to the tasks in blocks of bounded size. A text is cut into terms once per block and
leaves only its counts of the block's terms, as a table. The scores are products of dense
tiles: the weights of some items' own vocabulary, times the documents' impacts. All
numbers are whole, and a tile has so few terms that its sums stay below 2**53, where
float64 is exact; sums of tiles are 64-bit integers.
"""

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import materialized, rows_of, utf8

BEST = 10

#: Characters of the items that are held at once, on the driver and in each task.
BLOCK_CHARACTERS = 4_000_000
ITEM_TILE = 256
TERM_TILE = 2048
DOCUMENT_TILE = 512

#: An impact is below this.
_IMPACT_BOUND = 1_000_000

_TERM_BYTES = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256)).lower()

_POSTINGS = "doc_id long, n long, terms array<int>, counts array<long>"
_POSTINGS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
_BEST_SCHEMA = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all that is not ASCII, A-Z lower-cased."""
    return utf8(text).translate(_TERM_BYTES).split()


def _postings(vocabulary):
    """Number of terms and counts of the vocabulary's, for each text with a term."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            rows = []
            for doc_id, text in rows_of(batch, ["doc_id", "text"]):
                counts = Counter(terms_of(text))
                if counts:
                    known = list(counts.keys() & number.keys())
                    rows.append((doc_id, counts.total(), [number[t] for t in known], [counts[t] for t in known]))
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _POSTINGS_SCHEMA, strict=True)], schema=_POSTINGS_SCHEMA)

    return tally


class Corpus(NamedTuple):
    """Documents with a term, and all their terms."""

    documents: int
    terms: int


class Tile(NamedTuple):
    """Some items: the numbers of their terms, in order, and each pair's item, place of the term and weight."""

    first: int
    items: int
    terms: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    weight: np.ndarray


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def tiles_of(items: list[list[int]], weights: np.ndarray, size: int) -> list[Tile]:
    """``items`` has the distinct term numbers of each item."""
    tiles = []
    for first in range(0, len(items), size):
        part = items[first : first + size]
        numbers = np.array([t for own in part for t in own], np.int64)
        owner = np.repeat(np.arange(len(part)), [len(own) for own in part])
        terms, place = np.unique(numbers, return_inverse=True)
        tiles.append(Tile(first, len(part), terms, owner, place, weights[numbers].astype(np.float64)))
    return tiles


def term_width(heaviest: int, width: int) -> int:
    """Terms of a tile, at most ``width``, so that no sum of weight times impact reaches 2**53."""
    return max(1, min(width, (2**53 - 1) // (max(1, heaviest) * _IMPACT_BOUND)))


def scores(tile: Tile, owner: np.ndarray, terms: np.ndarray, impacts: np.ndarray, documents: int, width: int) -> np.ndarray:
    """Exact scores, documents by items, of the documents' (owner, term, impact) triples."""
    total = np.zeros((documents, tile.items), np.int64)
    place = np.searchsorted(tile.terms, terms)
    known = place < len(tile.terms)
    known[known] = tile.terms[place[known]] == terms[known]
    place, owner, impacts = place[known], owner[known], impacts[known]
    for low in range(0, len(tile.terms), width):
        high = min(low + width, len(tile.terms))
        here, there = (place >= low) & (place < high), (tile.place >= low) & (tile.place < high)
        if not here.any():
            continue
        documents_tile = np.zeros((documents, high - low))
        documents_tile[owner[here], place[here] - low] = impacts[here]
        items_tile = np.zeros((high - low, tile.items))
        items_tile[tile.place[there] - low, tile.owner[there]] = tile.weight[there]
        total += (documents_tile @ items_tile).astype(np.int64)
    return total


class Best:
    """The highest scores of every item so far; equal scores by ascending document, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.bar = np.ones(items, np.int64)  # least score that can still enter
        self.item, self.doc, self.null, self.score = (np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64))

    def add(self, first: int, total: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        bar = self.bar[first : first + total.shape[1]]
        if len(total) > self.k:
            bar = np.maximum(bar, np.partition(total, -self.k, axis=0)[-self.k])
        row, column = np.nonzero(total >= bar)
        if not len(row):
            return
        item, score = np.concatenate([self.item, column + first]), np.concatenate([self.score, total[row, column]])
        docs, nulls = np.concatenate([self.doc, doc[row]]), np.concatenate([self.null, null[row]])
        order = np.lexsort((docs, nulls, -score, item))
        item = item[order]
        start = np.concatenate([[True], item[1:] != item[:-1]])
        place = np.arange(len(item)) - np.flatnonzero(start)[np.cumsum(start) - 1]
        order, item = order[place < self.k], item[place < self.k]
        self.item, self.doc, self.null, self.score = item, docs[order], nulls[order], score[order]
        full = place[place < self.k] == self.k - 1
        self.bar[item[full]] = self.score[full]


def _rank(shared, corpus: Corpus, k: int, documents: int, width: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = shared.value
        best = Best(sum(t.items for t in tiles), k)
        for batch in (b.slice(i, documents) for b in batches for i in range(0, b.num_rows, documents)):
            ids, counts = batch.column("doc_id"), batch.column("counts")
            sizes = counts.value_lengths().to_numpy()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            # Python's integers: the product may pass 64 bits where the quotient does not.
            lengths = np.array([10 + 90 * n * corpus.documents // corpus.terms for n in batch.column("n").to_pylist()], np.int64)
            tf, terms = counts.flatten().to_numpy(), batch.column("terms").flatten().to_numpy()
            impacts = 1_000_000_000 * tf // (1000 * tf + 8 * lengths[owner])
            doc, null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            for tile in tiles:
                best.add(tile.first, scores(tile, owner, terms, impacts, len(sizes), width), doc, null)
        columns = [pa.array(best.item.astype(np.int32)), pa.array(best.doc, mask=best.null), pa.array(best.score)]
        yield pa.RecordBatch.from_arrays(columns, schema=_BEST_SCHEMA)

    return search


def _blocks(items: DataFrame, characters: int) -> Iterator[list]:
    """The distinct items in blocks of some ``characters`` each; one block at a time is on the driver."""
    items = items.select("item_id", "text").where("text is not null").distinct()
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = 1 + total // characters
    for block in range(blocks):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()


def ranked(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    block_characters: int = BLOCK_CHARACTERS,
    item_tile: int = ITEM_TILE,
    term_tile: int = TERM_TILE,
    document_tile: int = DOCUMENT_TILE,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item with a score above 0.

    ``docs(doc_id, text)`` are all ranked, ``items(item_id, text)`` is the stated query set. Equal
    scores rank by ascending doc_id, null last. A term weighs by the number of documents
    that hold it, its impact grows with its count and shrinks with the document's length.

    Null, empty and termless texts have no terms: such documents count nowhere, such items
    get no row. Items equal in both columns are one item; repeated documents rank each
    for itself. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    parts = []
    for number, block in enumerate(_blocks(items, block_characters)):
        vocabulary, owned = {}, []
        for row in block:
            owned.append([vocabulary.setdefault(t, len(vocabulary)) for t in dict.fromkeys(terms_of(row["text"]))])
        columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        postings = materialized(columns.mapInArrow(_postings(spark.sparkContext.broadcast(vocabulary)), _POSTINGS), "postings")
        corpus = Corpus(*postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first())
        holding = np.zeros(len(vocabulary), np.int64)
        for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holding[row["term"]] = row["count"]
        weights = np.array([weight(corpus.documents, h) for h in holding.tolist()], np.int64)
        width = term_width(int(weights.max(initial=0)), term_tile)
        shared = spark.sparkContext.broadcast(tiles_of(owned, weights, item_tile))
        found = postings.mapInArrow(_rank(shared, corpus, best, document_tile, width), "item int, doc_id long, score long")
        names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(block)], "item int, item_id long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
        part = top.join(names, "item").select("item_id", "rank", "doc_id", "score")
        # The next block's index comes after this one's: one at a time is in memory.
        parts.append(materialized(part, f"ranked-{number}"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
