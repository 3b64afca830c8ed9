"""Repair of conversations: cheapest edits to a well-formed sequence of roles.

The rows of a conversation span a lattice: a column between any two rows, and in each column a
node for what stands last in the repaired sequence so far. Arcs keep, rerole or delete a row, or
insert a turn. An auction finds the cheapest way: a path grows from the origin along
arcs that are tight under the nodes' prices, and shrinks where a price must rise first. At
the end all cheapest ways are tight under the prices; the least letter at each node that still
leads to the end gives the way that is least in ASCII.

A conversation is read backwards in blocks of columns. Prices at a block's left edge are
exact and stand for all that follows, so that the state is four numbers, however long
the conversation is. Each row keeps the best letter for each node of its column;
a second, forward reading follows them.
"""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import rows_of, utf8

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1

#: Rows whose lattice one auction solves.
BLOCK_ROWS = 32

# What stands last: nothing, a system turn, a user turn, an assistant turn.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = 4
#: The state after a user or assistant turn is added.
_ADDED = [_USER, _USER, _ASSISTANT, _USER]
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: The price of finishing from each state: a sequence ends empty or after an assistant turn.
_END = [0, 2 * INSERT, INSERT, 0]

_SPACES = " \t\n\x0b\f\r"


def _kept(state: int, initial: str) -> int | None:
    """The state after a row of this role initial is kept."""
    if initial == "s":
        return _SYSTEM if state == _NOTHING else None
    return _ADDED[state] if initial == ("a" if state == _USER else "u") else None


class Row(NamedTuple):
    initial: str
    fault: str  # blank, duplicate, truncated or nothing


def row_arcs(state: int, row: Row) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of all edits of a row."""
    arcs = [("D", DELETE, state)]
    if row.fault not in ("blank", "duplicate"):
        extra = TRUNCATED if row.fault == "truncated" else 0
        if (after := _kept(state, row.initial)) is not None:
            arcs.append(("K", KEEP + extra, after))
        arcs.append(("R", REROLE + extra, _ADDED[state]))
    return arcs


class Lattice:
    """The lattice of a block of rows; node ``4 * column + state``, and the end behind the last column."""

    def __init__(self, rows: list[Row], ends: list[int]):
        self.columns = len(rows)
        self.end = _STATES * (self.columns + 1)
        self.arcs: list[list[tuple[str, int, int]]] = []
        for column in range(self.columns + 1):
            for state in range(_STATES):
                arcs = [("I", INSERT, _STATES * column + _ADDED[state])]
                if column < self.columns:
                    arcs += [(letter, cost, _STATES * (column + 1) + after) for letter, cost, after in row_arcs(state, rows[column])]
                else:
                    arcs.append(("", ends[state], self.end))
                self.arcs.append(arcs)


def auction(lattice: Lattice, prices: list[int], origin: int) -> None:
    """Raises the prices until the origin's is its distance to the end.

    Costs are whole and no cycle is free, so every contraction raises a price by at
    least one, and no price passes its node's distance.
    """
    path = [origin]
    while (node := path[-1]) != lattice.end:
        least, head = min((cost + prices[head], head) for _, cost, head in lattice.arcs[node])
        if prices[node] == least:
            path.append(head)
        else:
            prices[node] = least
            if len(path) > 1:
                path.pop()


def policies(rows: list[Row], ends: list[int]) -> tuple[list[str], list[int]]:
    """The best letters of every row, one for each state, and the prices at the block's left edge.

    ``ends`` are the exact prices at its right edge. A letter is ``-`` where no cheapest way passes.
    """
    base = min(ends)
    lattice = Lattice(rows, [e - base for e in ends])
    prices = [0] * (lattice.end + 1)
    for state in range(_STATES):
        auction(lattice, prices, state)
    best = [""] * lattice.end
    reaches = [False] * lattice.end + [True]
    for column in range(lattice.columns, -1, -1):
        nodes = range(_STATES * column, _STATES * (column + 1))
        for _ in range(_STATES):  # inserted turns stay in the column; three of them reach all states
            for node in nodes:
                tight = [letter for letter, cost, head in lattice.arcs[node] if reaches[head] and prices[node] == cost + prices[head]]
                if tight:
                    best[node], reaches[node] = min(tight), True
    letters = ["".join(b or "-" for b in best[_STATES * c : _STATES * (c + 1)]) for c in range(lattice.columns)]
    return letters, [base + p for p in prices[:_STATES]]


def _backwards(block_rows: int):
    """Adds the best letters to rows that come by conversation, last row first."""

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, ends = object(), _END
        for batch in batches:
            letters = []
            block = []

            def solve():
                nonlocal ends
                best, ends = policies(block[::-1], ends)
                letters.extend(best[::-1])
                block.clear()

            for conv_id, initial, fault, present in rows_of(batch, ["conv_id", "initial", "fault", "present"]):
                if conv_id != conversation:
                    solve()
                    conversation, ends = conv_id, _END
                if not present:
                    solve()
                    letters.append(None)
                    continue
                block.append(Row(initial, fault))
                if len(block) == block_rows:
                    solve()
            solve()
            yield batch.append_column("letters", pa.array(letters, pa.string()))

    return price


class Walk:
    """Follows the best letters through one conversation, first row first."""

    def __init__(self):
        self.state, self.cost, self.audit = _NOTHING, 0, bytearray()

    def _insert(self) -> tuple[str, str, str]:
        self.state = _ADDED[self.state]
        self.cost += INSERT
        self.audit += b"I"
        return "I", _ROLE[self.state], ""

    def row(self, role: str, text: str, row: Row, letters: str) -> Iterator[tuple[str, str, str]]:
        """Letter, role and text of the turns that come of a row."""
        while letters[self.state] == "I":
            yield self._insert()
        letter = letters[self.state]
        cost, after = next((cost, after) for name, cost, after in row_arcs(self.state, row) if name == letter)
        self.state = after
        self.cost += cost
        self.audit += letter.encode()
        if letter != "D":
            yield letter, _ROLE[after] if letter == "R" else role, text

    def finish(self) -> Iterator[tuple[str, str, str]]:
        while self.state in (_SYSTEM, _USER):
            yield self._insert()


_COLUMNS = ["conv_id", "turn", "role", "text", "initial", "fault", "present", "letters"]
_LEGAL = {"su", "ua", "au"}


class Record:
    """What one conversation comes to."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.walk = Walk()
        self.digest, self.some = hashlib.sha256(), False
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.first_turn, self.last_turn, self.turns = None, None, 0

    def _add(self, edits) -> None:
        for _, role, text in edits:
            self.digest.update((b"\n" if self.some else b"") + utf8(role) + b":" + utf8(text))
            self.some = True

    def row(self, turn, role, text, row: Row, letters) -> None:
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        if row.fault:
            self.faults[row.fault] += 1
        if self.before is not None:
            self.illegal += self.before + row.initial not in _LEGAL
        self.before = row.initial
        self._add(self.walk.row(role, text, row, letters))

    def finish(self) -> tuple:
        self._add(self.walk.finish())
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.walk.cost, self.walk.audit.decode(), self.digest.hexdigest())


_RECORD = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURN = "conv_id long, place long, edit string, role string, text string"
_SCHEMAS = {
    text: pa.schema([(n, {"long": pa.int64(), "string": pa.string()}[t]) for n, t in (c.split() for c in text.split(", "))]) for text in (_RECORD, _TURN)
}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMAS[schema], strict=True)], schema=_SCHEMAS[schema])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    record, done = None, []
    for batch in batches:
        for conv_id, turn, role, text, initial, fault, present, letters in rows_of(batch, _COLUMNS):
            if record is None or record.conv_id != conv_id:
                if record is not None:
                    done.append(record.finish())
                record = Record(conv_id)
            if present:
                record.row(turn, role, text, Row(initial, fault), letters)
        if done:
            yield _batch(done, _RECORD)
            done = []
    if record is not None:
        yield _batch([record.finish()], _RECORD)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conversation, walk, place, done = object(), Walk(), 0, []

    def add(edits):
        nonlocal place
        for edit, role, text in edits:
            done.append((conversation, place, edit, role, text))
            place += 1

    for batch in batches:
        for conv_id, _, role, text, initial, fault, present, letters in rows_of(batch, _COLUMNS):
            if conv_id != conversation:
                add(walk.finish())
                conversation, walk, place = conv_id, Walk(), 0
            if present:
                add(walk.row(role, text, Row(initial, fault), letters))
            if len(done) >= 1000:
                yield _batch(done, _TURN)
                done = []
    add(walk.finish())
    if done:
        yield _batch(done, _TURN)


def _solved(turns: DataFrame, present: Column | None, block_rows: int) -> DataFrame:
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    ).repartition("conv_id")
    # Partitions by conversation also hold equal rows together: no second shuffle.
    equal = Window.partitionBy("conv_id", "role", "text", "present").orderBy(F.asc_nulls_first("turn"))
    trimmed = F.rtrim("text", F.lit(_SPACES))
    fault = (
        F.when(trimmed == "", "blank")
        .when(F.col("copy") > 1, "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    rows = rows.withColumn("copy", F.row_number().over(equal)).withColumns({"fault": fault, "initial": F.substring("role", 1, 1)})
    last_first = rows.sortWithinPartitions("conv_id", F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("copy"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    priced = last_first.mapInArrow(_backwards(block_rows), f"{schema}, letters string")
    return priced.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "copy")


def repair(turns: DataFrame, present: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each conversation of ``turns(conv_id, turn, role, text)``: its faults, its repair's cost and edits.

    ``gaps`` are missing turn numbers, ``blank``, ``duplicate`` and ``truncated`` rows by their
    first fault, ``illegal`` neighbours whose role initials are not ``su``, ``ua`` or ``au``.
    ``audit`` has the letters of the cheapest edits (Keep, Rerole, Delete, Insert) to role initials
    ``(s?(ua)+)?``, the least in ASCII of equal ones; ``repaired_sha256`` is of the repaired ``role:text`` lines.
    Where ``present`` is false a row only names its conversation.

    One shuffle, by conversation. A conversation streams through one task in its order, as
    its digest and its audit demand; the state is constant but for the audit.

    Null roles and texts are one space, null turns come first, null conv_ids are one conversation.
    Rows of one turn stand by role and text; of rows equal in both, all but the first of the
    conversation are duplicates. A conversation without rows has no cost and an empty audit.
    An empty table gives an empty result; other columns are not read.
    """
    return _solved(turns, present, block_rows).mapInArrow(_records, _RECORD)


def repaired_turns(turns: DataFrame, present: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired rows ``conv_id, place, edit, role, text``, edit being K, R or I; see ``repair``."""
    return _solved(turns, present, block_rows).mapInArrow(_turns, _TURN)


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: rows harmed by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 makes a row absent, 1 empties its text, 2 takes ``.!?`` out of it, 3 doubles the row, 4
    makes it a user's. Nulls are one space, in the key as in role and text.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    harm = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(role).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (harm != 0).alias("present"),
        F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    )
    return rows.drop("again")
