"""Sharding by histogram sort: exact byte counts below candidate boundaries, refined, then one exchange.

Rows are ordered by the hash of their text, then by a hash of the whole row, so equal
texts are neighbours. A histogram counts rows and bytes of every cell of the key space.
Cells in which a splitter falls, and cells with too many rows, are counted again in finer cells,
until every splitter lies within the tolerance of its target. Only these counts reach the
driver. The cells then give every row its shard and the base of its slot, and one exchange
by cell numbers the rows. All of it is DataFrame expressions.
"""

import bisect
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import hashable_columns, materialized

#: Key bits that tell cells apart, level by level; first of the text's hash, then of the row's.
LEVELS = [(12, 0), (18, 0), (24, 0), (30, 0), (63, 0), (63, 6), (63, 12), (63, 18), (63, 63)]
KEY_BITS = 63

#: A splitter may miss its target by this part of a shard.
TOLERANCE = 0.002
#: Larger cells are refined: one task sorts a cell. A cell holds so many rows, or this part of all, at most.
CELL_ROWS = 4_000_000
CELL_SHARE = 1 / 1024

Cell = tuple[int, int]  # leading bits of the two keys, left-aligned


@dataclass
class Histogram:
    """Counts of the cells, by level; a refined cell is replaced by the cells of the next level."""

    cells: dict[Cell, tuple[int, int, int]]  # level, rows, bytes
    refined: list[list[Cell]] = field(default_factory=lambda: [[] for _ in LEVELS])

    def ordered(self) -> list[tuple[Cell, int, int, int]]:
        return sorted((cell, *counts) for cell, counts in self.cells.items())


def _leading(key: str, bits: int) -> Column:
    """The key with all but its leading bits cleared."""
    return F.col(key) if bits == KEY_BITS else F.shiftleft(F.shiftright(F.col(key), KEY_BITS - bits), KEY_BITS - bits) if bits else F.lit(0).cast("long")


def _cell(level: int) -> Column:
    first, second = LEVELS[level]
    return F.struct(_leading("key1", first).alias("a"), _leading("key2", second).alias("b"))


def _among(level: int, cells: list[Cell]) -> Column:
    """Whether the row's cell of a level is one of these; literals, tested by hash set."""
    first, second = LEVELS[level]
    if second == 0:
        return _leading("key1", first).isin([a for a, _ in cells])
    texts = sorted({a for a, _ in cells})
    return F.col("key1").isin(texts) & _cell(level).isin([F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in cells])


def _counts(keys: DataFrame, level: int) -> dict[Cell, tuple[int, int, int]]:
    rows = keys.groupBy(_cell(level).alias("cell")).agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).collect()
    return {(r["cell"]["a"], r["cell"]["b"]): (level, r["rows"], r["bytes"]) for r in rows}


def _nearest(edges: list[int], target: float) -> tuple[int, float]:
    """Number of cells before the edge nearest to the target, and its distance."""
    right = bisect.bisect_left(edges, target)
    return min(((i, abs(edges[i] - target)) for i in (right - 1, right) if 0 <= i < len(edges)), key=lambda x: (x[1], x[0]))


def find_splitters(keys: DataFrame, shards: int, tolerance: float, cell_rows: int) -> tuple[Histogram, list[tuple[int, int]], set[Cell]]:
    """Refines the histogram of ``keys(key1, key2, size)`` until the splitters are near their targets.

    Gives the cells; for each shard but the first, how many cells precede it and how many rows
    of the next one, which is 0 but in a cell of equal rows; and the cells of equal rows
    that are too large for one task or hold a splitter.
    """
    histogram = Histogram(_counts(keys, 0))
    cell_rows = min(cell_rows, max(16, CELL_SHARE * sum(rows for _, rows, _ in histogram.cells.values())))
    for level in range(len(LEVELS)):
        ordered = histogram.ordered()
        edges = [0]
        for _, _, _, size in ordered:
            edges.append(edges[-1] + size)
        splitters, wanted = [], {cell for cell, at, rows, _ in ordered if at == level and rows > cell_rows}
        for shard in range(1, shards):
            target = edges[-1] * shard / shards
            before, distance = _nearest(edges, target)
            splitters.append((before, 0))
            if distance > tolerance * edges[-1] / shards:
                inside = before if edges[before] < target else before - 1
                cell, at, rows, size = ordered[inside]
                if at == level and rows > 1:
                    wanted.add(cell)
                    if at + 1 == len(LEVELS):
                        # Equal rows have equal sizes.
                        splitters[-1] = (inside, round((target - edges[inside]) * rows / size))
        if not wanted or level + 1 == len(LEVELS):
            return histogram, splitters, wanted
        histogram.refined[level] = sorted(wanted)
        for cell in wanted:
            del histogram.cells[cell]
        histogram.cells |= _counts(keys.where(_among(level, histogram.refined[level])), level + 1)


def _segments(histogram: Histogram, splitters: list[tuple[int, int]], shards: int) -> list[tuple]:
    """``level, a, b, first, rows, shard, base``: the rows of a cell from ``first`` on, their shard, and the slot of the first."""
    out, shard_rows = [], [0] * shards
    cuts: dict[int, list[int]] = {}
    for cell, row in splitters:
        cuts.setdefault(cell, []).append(row)
    home = 0
    for number, ((a, b), level, rows, _) in enumerate(histogram.ordered()):
        edges = sorted(cuts.get(number, []))
        first = 0
        for end in [*edges, rows]:
            if end > first:
                out.append((level, a, b, first, end - first, home, shard_rows[home]))
                shard_rows[home] += end - first
                first = end
            home += 1
        home -= 1  # the last piece ends with the cell, not with a splitter
    return out


def shard(docs: DataFrame, shards: int = 24, tolerance: float = TOLERANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Puts every row of ``docs(doc_id, text)`` into one of ``shards`` of nearly equal bytes.

    Gives ``row`` (the input row as a struct), ``size`` (UTF-8 bytes of the text, null: none, plus
    8), ``shard`` and ``slot``, gapless from 0 and ascending in the sort order. Equal texts
    are in one shard unless a splitter must part them to stay within the tolerance; so are rows
    equal in all columns, which a splitter may part as well. An empty table gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    hashable = hashable_columns(docs)
    key = [F.shiftrightunsigned(x, 1) for x in (F.xxhash64("text"), F.xxhash64(*hashable))]
    keyed = docs.select(row.alias("row"), _size(F.col("text")).alias("size"), key[0].alias("key1"), key[1].alias("key2"), F.xxhash64(F.lit(3), *hashable).alias("key3"))
    keys = materialized(keyed.select("key1", "key2", "size"), "shard-keys")
    histogram, splitters, equal = find_splitters(keys, shards, tolerance, cell_rows)
    places = _segments(histogram, splitters, shards)
    last = len(LEVELS) - 1
    alone = [p for p in places if p[0] < last or p[1:3] not in equal]
    columns = "level int, a long, b long, first long, rows long, shard int, base long"
    cells = docs.sparkSession.createDataFrame(alone, columns).select("level", "a", "b", "shard", "base")

    level = F.lit(last)
    for depth in reversed(range(last)):
        refined = histogram.refined[depth]
        level = F.when(_among(depth, refined), level).otherwise(F.lit(depth)) if refined else F.lit(depth)
    cell = _cell(last)
    for depth in reversed(range(last)):
        cell = F.when(level == depth, _cell(depth)).otherwise(cell)
    placed = keyed.withColumns({"level": level, "cell": cell}).select("row", "size", "key1", "key2", "key3", "level", "cell.a", "cell.b")
    # One row per cell: bounded by the histogram, not by the data. Rows of equal cells find no partner.
    single = placed.drop("key3").join(F.broadcast(cells), ["level", "a", "b"])
    order = Window.partitionBy("level", "a", "b").orderBy("key1", "key2")
    result = single.select("row", "size", "shard", (F.col("base") + F.row_number().over(order) - 1).alias("slot"))
    if not equal:
        return result
    parts = _parts_of([p for p in places if p[0] == last and p[1:3] in equal], cell_rows)
    return result.unionByName(_multiplied(placed.where((F.col("level") == last) & _among(last, sorted(equal))), docs.sparkSession.createDataFrame(parts, columns), len(parts)))


def _parts_of(places: list[tuple], rows: int) -> list[tuple]:
    """Segments of equal rows cut into parts of at most ``rows``."""
    return [
        (*place[:3], place[3] + at, min(rows, place[4] - at), place[5], place[6] + at) for place in places for at in range(0, place[4], rows)
    ]


def _multiplied(rows: DataFrame, parts: DataFrame, number: int) -> DataFrame:
    """Equal rows by their parts: counted before their shuffle, and multiplied where the parts are dealt to.

    A third hash parts rows of one cell that are not equal after all; their numbers follow each other.
    """
    groups = rows.groupBy("level", "a", "b", "key3").agg(F.first("row").alias("row"), F.first("size").alias("size"), F.count("*").alias("copies"))
    order = Window.partitionBy("level", "a", "b").orderBy("key3")
    groups = groups.withColumn("until", F.sum("copies").over(order)).withColumn("start", F.col("until") - F.col("copies"))
    met = groups.join(F.broadcast(parts), ["level", "a", "b"]).withColumns(
        {"low": F.greatest("start", "first"), "high": F.least("until", F.col("first") + F.col("rows")) - 1}
    )
    # By a number of its own, else adaptive execution merges the parts, which are small until they are multiplied.
    dealt = met.where("low <= high").repartition(number, "a", "b", "first", "key3")
    placed = dealt.withColumn("at", F.explode(F.sequence("low", "high")))
    return placed.select("row", "size", "shard", (F.col("base") + F.col("at") - F.col("first")).alias("slot"))


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
