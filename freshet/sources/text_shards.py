"""Text files by name and number: ``<prefix>-SSSSS-of-NNNNN<suffix>``, one line a row.

A Spark data source that only writes. Tasks write below a folder of the write's own; what each
finished task made is renamed when all are done, and what failed or repeated attempts left
goes with that folder. The number in the names tells whether all files of a set are there.
"""

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

from freshet.sources.zarr import file_system


@dataclass
class Shard(WriterCommitMessage):
    """A file that one task wrote: its partition and its name in the write's own folder."""

    partition: int
    file: str


def shard_name(prefix: str, number: int, total: int, suffix: str) -> str:
    return f"{prefix}-{number:05d}-of-{total:05d}{suffix}"


def _present(system: fs.FileSystem, prefix: str, suffix: str) -> dict[tuple[int, int], str]:
    """Files of the prefix by number and total."""
    folder, _, name = prefix.rpartition("/")
    pattern = re.compile(rf"{re.escape(name)}-(\d{{5,}})-of-(\d{{5,}}){re.escape(suffix)}")
    found = {}
    for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if info.type == fs.FileType.File and (match := pattern.fullmatch(info.base_name)):
            found[int(match[1]), int(match[2])] = info.path
    return found


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.prefix, self.suffix = options["path"], options.get("suffix", "")
        self.header = options.get("header")
        self.overwrite = overwrite
        self.staging = f".shards-{uuid.uuid4().hex}"
        system, prefix = file_system(self.prefix)
        if not overwrite and _present(system, prefix, self.suffix):
            raise FileExistsError(f"there are shards of {self.prefix} already")

    def _folder(self, prefix: str) -> str:
        return f"{prefix.rpartition('/')[0]}/{self.staging}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shard:
        system, prefix = file_system(self.prefix)
        partition = TaskContext.get().partitionId()
        name = f"{partition}-{uuid.uuid4().hex}"
        system.create_dir(self._folder(prefix), recursive=True)
        with system.open_output_stream(f"{self._folder(prefix)}/{name}", compression=None) as stream:
            if self.header is not None:
                stream.write(self.header.encode() + b"\n")
            for batch in iterator:
                for start in range(0, batch.num_rows, 1000):
                    lines = batch.column(0).slice(start, 1000).to_pylist()
                    stream.write("".join(f"{'' if line is None else line}\n" for line in lines).encode())
        return Shard(partition, name)

    def commit(self, messages: list[Shard]) -> None:
        system, prefix = file_system(self.prefix)
        shards = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        targets = [shard_name(prefix, i, len(shards), self.suffix) for i in range(len(shards))]
        stale = set(_present(system, prefix, self.suffix).values()) - set(targets) if self.overwrite else ()
        for shard, target in zip(shards, targets):
            system.move(f"{self._folder(prefix)}/{shard.file}", target)
        for path in stale:
            system.delete_file(path)
        self._clear(system, prefix)

    def abort(self, messages) -> None:
        self._clear(*file_system(self.prefix))

    def _clear(self, system: fs.FileSystem, prefix: str) -> None:
        if system.get_file_info(self._folder(prefix)).type == fs.FileType.Directory:
            system.delete_dir(self._folder(prefix))


class TextShards(DataSource):
    """Options: ``path`` (the prefix), ``suffix``, and ``header``, a first line for every file."""

    @classmethod
    def name(cls):
        return "text_shards"

    def writer(self, schema: StructType, overwrite: bool):
        if [f.dataType for f in schema.fields] != [StringType()]:
            raise ValueError("text shards take one column of strings")
        return ShardWriter(self.options, overwrite)


def write_shards(records: DataFrame, prefix: str, shards: int | None = None, suffix: str = "", mode: str = "append", header: str | None = None) -> None:
    """Write rows as lines of exactly ``shards`` files, empty ones too; by default one per partition.

    A frame of one string column is written as it is, nulls as empty lines; other rows as JSON. Mode
    ``append`` is an error where the prefix and suffix have shards; ``overwrite`` replaces these, whatever their number.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    if shards is not None and shards < 1:
        raise ValueError("a set has at least one shard")
    lines = records if [f.dataType for f in records.schema.fields] == [StringType()] else records.select(F.to_json(F.struct("*")).alias("value"))
    if shards is not None:
        lines = lines.repartition(shards)
    records.sparkSession.dataSource.register(TextShards)
    options = {"suffix": suffix} | ({} if header is None else {"header": header})
    lines.write.format("text_shards").mode(mode).options(**options).save(prefix)


def shard_files(prefix: str, suffix: str = "") -> list[str]:
    """Paths of a whole set in order; an incomplete set, or two of them, is an error."""
    system, path = file_system(prefix)
    found = _present(system, path, suffix)
    totals = {total for _, total in found}
    if len(totals) != 1 or len(found) != max(totals):
        raise FileNotFoundError(f"{prefix} has {len(found)} shards of sets of {sorted(totals)}")
    scheme = prefix[: len(prefix) - len(path)] if prefix.endswith(path) else ""
    return [scheme + found[key] for key in sorted(found)]


def read_shards(spark: SparkSession, prefix: str, suffix: str = "", schema: StructType | str | None = None) -> DataFrame:
    """The lines of a whole set as ``value``, or its JSON records where a schema is given."""
    files = shard_files(prefix, suffix)
    return spark.read.text(files) if schema is None else spark.read.schema(schema).json(files)
