"""Helpers shared by the operators of this subpackage."""

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import scratch_path

#: Distinct words a task remembers; beyond that it starts a fresh vocabulary.
VOCABULARY_WORDS = 300_000


def materialized(frame: DataFrame, name: str) -> DataFrame:
    """Writes a frame below the shared checkpoint folder and reads it back.

    This cuts the lineage: lost executors cost a re-read, not a recomputation.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def shuffles_cleared(spark: SparkSession):
    """Shuffle files go with the query that wrote them, so that those of one step after the other do not add up on disk."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of(batch: pa.RecordBatch, columns: list[str]) -> Iterator[tuple]:
    """Rows of a batch, a thousand at a time, so that few Python objects live at once."""
    for start in range(0, batch.num_rows, 1000):
        part = batch.slice(start, 1000)
        yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def hashable_columns(docs: DataFrame, inside: str = "") -> list[Column]:
    """All columns, or the same fields of the struct ``inside``, as something that can be hashed; maps, and what holds them, as JSON."""
    named = lambda f: F.col(f"{inside}.`{f.name}`" if inside else f"`{f.name}`")
    return [F.to_json(F.struct(named(f))) if "map<" in f.dataType.simpleString() else named(f) for f in docs.schema]


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


class Vocabulary(dict):
    """Numbers words in order of first sight and keeps a 64-bit hash of each.

    ``bytes.split()`` splits at exactly the six ASCII white-space characters, so a text's
    words are ``utf8(text).split()``.
    """

    def __init__(self):
        super().__init__()
        self._hashes = np.empty(1024, np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = len(self)
        if number == len(self._hashes):
            self._hashes = np.concatenate([self._hashes, np.empty(number, np.uint64)])
        self._hashes[number] = xxhash.xxh64_intdigest(word)
        self[word] = number
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self) > VOCABULARY_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        return self._hashes[numbers]
