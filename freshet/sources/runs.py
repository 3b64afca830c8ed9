"""Tables of a run that appear together or not at all.

A run store is a folder. Every attempt at a run writes its tables below folders of its own,
``<table>/run_id=<run>/attempt=<attempt>``, that nobody reads yet. One small file in the log
then names the attempt, and with it all its tables count. Readers follow the log and nothing
else: what an attempt left that failed or still runs is not there for them. Nothing is ever
overwritten in place, so a reader that has its snapshot goes on with it while others commit.

Long runs may be done in parts. A finished part is noted in the same log, where a restarted run
finds it; the parts become visible when the whole run is committed.
"""

import re
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

_ENTRY = "version long, kind string, run_id string, mode string, part string, attempts array<struct<name: string, tables: array<string>>>"


def _checked(run_id: str) -> str:
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"a run id names a folder; {run_id!r} has other characters than letters, digits, _ . -")
    return run_id


class Snapshot:
    """What the store holds at one moment: the attempts that count, for each run."""

    def __init__(self, spark: SparkSession, root: str, entries: list):
        self._spark, self._root = spark, root
        self.attempts: dict[str, list] = {}
        for entry in entries:
            if entry["kind"] == "run":
                before = [] if entry["mode"] == "overwrite" else self.attempts.get(entry["run_id"], [])
                self.attempts[entry["run_id"]] = before + entry["attempts"]

    @property
    def runs(self) -> list[str]:
        return sorted(self.attempts)

    def read(self, table: str, schema: StructType, run_id: str | None = None) -> DataFrame:
        """Rows of one run or of all, with the column ``run_id``; ``schema`` has the table's own columns."""
        runs = self.runs if run_id is None else [run_id]
        made = [(run, a["name"]) for run in runs for a in self.attempts.get(run, []) if table in a["tables"]]
        folders = [f"{self._root}/{table}/run_id={run}/attempt={name}" for run, name in made]
        stored = StructType([*schema.fields]).add("run_id", "string")
        if not folders:
            return self._spark.createDataFrame([], stored)
        rows = self._spark.read.option("basePath", f"{self._root}/{table}").schema(StructType([*stored.fields]).add("attempt", "string"))
        return rows.parquet(*folders).drop("attempt")


class Attempt:
    """One try at a run, or at a part of it; invisible until committed."""

    def __init__(self, store: "RunStore", run_id: str, mode: str, part: str | None = None):
        if mode not in ("append", "overwrite"):
            raise ValueError(f"unknown mode {mode!r}")
        self.store, self.run_id, self.mode, self.part = store, _checked(run_id), mode, part
        self.name, self.tables = uuid.uuid4().hex, []

    def _folder(self, table: str) -> str:
        return f"{self.store.root}/{table}/run_id={self.run_id}/attempt={self.name}"

    def write(self, table: str, frame: DataFrame, *partitions: str) -> None:
        frame.write.mode("error").partitionBy(*partitions).parquet(self._folder(table))
        self.tables.append(table)

    def read(self, table: str, schema: StructType) -> DataFrame:
        """This attempt's own rows, which nobody else sees yet."""
        return self.store.spark.read.schema(schema).parquet(self._folder(table))

    def commit(self) -> None:
        """Make all tables of the attempt count, or note the part as finished."""
        self.store._append("run" if self.part is None else "part", self.run_id, self.mode, self.part, [(self.name, self.tables)])


class RunStore:
    """A folder of tables and the log of their runs; any path or URI that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def entries(self) -> list:
        """The log, one row a commit, oldest first; attempts that saw the same log are ordered by their names."""
        try:
            rows = self.spark.read.schema(_ENTRY).json(f"{self.root}/_log").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        return sorted(rows, key=lambda r: (r["version"], r["attempts"]))

    def snapshot(self) -> Snapshot:
        return Snapshot(self.spark, self.root, self.entries())

    def attempt(self, run_id: str, mode: str = "append", part: str | None = None) -> Attempt:
        return Attempt(self, run_id, mode, part)

    def _append(self, kind: str, run_id: str, mode: str, part: str | None, attempts: list[tuple]) -> None:
        version = 1 + max((e["version"] for e in self.entries()), default=0)
        entry = self.spark.createDataFrame([(version, kind, run_id, mode, part, attempts)], _ENTRY)
        # One file, which its job commit renames into place: the entry is there whole or not.
        entry.coalesce(1).write.mode("append").json(f"{self.root}/_log")

    def finished(self, run_id: str) -> dict[str, tuple]:
        """Finished parts of the run that is under way, and the attempt and tables of each."""
        parts: dict[str, tuple] = {}
        for entry in self.entries():
            if entry["run_id"] == run_id:
                parts = {} if entry["kind"] == "run" else parts | {entry["part"]: tuple(entry["attempts"][0])}
        return parts

    def run_parts(self, run_id: str, parts: Iterable[str], work: Callable[[Attempt, str], None], mode: str = "overwrite") -> list[str]:
        """Does each part that is not yet finished, then commits them all as one run.

        ``work(attempt, part)`` writes the part's tables. A part that fails leaves the finished
        ones in the log, and the next call with the same run id goes on from there. Returns
        the parts done in this call.
        """
        parts, done = list(parts), []
        if len(set(parts)) < len(parts):
            raise ValueError("parts must differ by name")
        known = self.finished(_checked(run_id))
        for part in parts:
            if part not in known:
                attempt = self.attempt(run_id, mode, part)
                work(attempt, part)
                attempt.commit()
                known[part] = (attempt.name, attempt.tables)
                done.append(part)
        self._append("run", run_id, mode, None, [known[part] for part in parts])
        return done
