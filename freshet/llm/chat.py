"""Chat formatting into a prefix tree: shared initial turns are emitted once, depth first.

A turn becomes a segment of formatted text and its tokens. Conversations that begin with the
same turns share the nodes of those turns: a node is named by a hash of its turn and of its
parent. The tree is laid out depth first: each node's tokens stand once, from ``start`` on;
their position ids begin at ``position``, the length of the path above; and they attend to the
intervals of the layout in which their ancestors stand, and causally to their own node.

The order comes from sorting conversations by the path of their shared nodes, of which those
suffice that fewer conversations pass than their parent. A node belongs to the first
conversation in that order that passes it, and the nodes a conversation owns follow one
another, so offsets are running sums over the sorted conversations. All this works on names
and sizes; tokens join once the layout is known.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.common import materialized, rows_of
from freshet.llm.packing import CachedTokenizer, decoder

# The template. "\" escapes itself, and "<" becomes "\l", so that no text can hold a mark.
OPEN, HEAD_END, CLOSE = "<turn>", "\n", "</turn>\n"
LOSS_ROLES = frozenset({"assistant"})

_TURN = re.compile(r"<turn>([^<\n]*)\n([^<]*)</turn>\n")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "<" if m[1] == "l" else m[1], text, flags=re.DOTALL)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"l": "<", "n": "\n"}.get(m[1], m[1]), role, flags=re.DOTALL)


def format_turn(role: str | None, text: str | None) -> str:
    return f"{OPEN}{escape_role(role or '')}{HEAD_END}{escape(text or '')}{CLOSE}"


def parse_turn(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    turn = _TURN.fullmatch(segment)
    if turn is None:
        raise ValueError("not a formatted turn")
    return unescape_role(turn[1]), unescape(turn[2])


TURNS = "conv string, conv_id long, n long, node string, parent string, tokens array<int>, loss_start long, loss_end long"
_TURN_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.int64(), pa.int64()]


def _link_turns(tokenizer_path: str, loss_roles: frozenset[str]):
    """Rows sorted by conversation and turn; the state is one hash, whatever the number of turns."""
    names = [f.split()[0] for f in TURNS.split(", ")]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = CachedTokenizer(tokenizer_path)
        last, node, n = None, None, 0
        for batch in batches:
            rows, pieces, ends = [], [], [0]
            for conv, conv_id, role, text in rows_of(batch, ["conv", "conv_id", "role", "text"]):
                if conv != last:
                    last, node, n = conv, None, 0
                segment, parent = format_turn(role, text), node
                data = f"{parent or ''}|{segment}".encode("utf-8", "surrogatepass")
                node = hashlib.blake2b(data, digest_size=16).hexdigest()
                body = segment.index(HEAD_END) + len(HEAD_END)
                # Head, text and close are encoded apart, so that the loss mask ends where the text does.
                parts = list(tokenizer.encode([segment[:body], segment[body : -len(CLOSE)], CLOSE]))
                start, size = len(parts[0]), sum(map(len, parts))
                rows.append((conv, conv_id, n, node, parent, start, start + (len(parts[1]) if (role or "") in loss_roles else 0)))
                pieces += parts
                ends.append(ends[-1] + size)
                n += 1
            if rows:
                columns = list(zip(*rows, strict=True))
                tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(pieces).astype(np.int32)))
                arrays = [pa.array(c, t) for c, t in zip(columns[:5], _TURN_TYPES, strict=False)]
                arrays += [tokens, *[pa.array(c, pa.int64()) for c in columns[5:]]]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return link


def linked_turns(conversations: DataFrame, tokenizer_path: str, loss_roles: frozenset[str] = LOSS_ROLES) -> DataFrame:
    """Every turn with its node, parent and tokens; rows with equal turn go by role and text.

    ``conv`` is a name of the conversation that also a null conv_id has.
    """
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    rows = conversations.select(conv.alias("conv"), "conv_id", "turn", "role", "text")
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return rows.select("conv", "conv_id", "role", "text").mapInArrow(_link_turns(tokenizer_path, loss_roles), TURNS)


def _ranks(turns: DataFrame) -> DataFrame:
    """``conv, rank``: ascending in an order in which the conversations of every node are neighbours.

    Only nodes that several conversations pass matter for that, and of these only the ones that
    fewer pass than their parent: below them the same conversations go on together. So a sort key
    grows with the forks on a path, not with its turns. The shared nodes are a table of
    their own, so that Spark can split the turns of a very common one in the join.
    """
    passes = materialized(turns.groupBy("node").agg(F.count("*").alias("passes")).where("passes > 1"), "passes")
    shared = turns.select("conv", "n", "node").join(passes, "node")
    above = F.lag("passes").over(Window.partitionBy("conv").orderBy("n"))
    forks = shared.withColumn("above", above).where("above is null or passes <> above")
    forks = forks.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("n", "node"))).alias("path"))
    path = F.array_join(F.transform("path", lambda p: p["node"]), "")
    keys = turns.where("n = 0").select("conv", F.col("node").alias("root")).join(forks, "conv", "left")
    keys = materialized(keys.select("conv", F.coalesce(path, "root").alias("path")), "paths")
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.repartitionByRange(parts, "path", "conv").sortWithinPartitions("path", "conv")
    return materialized(ordered.select("conv", F.monotonically_increasing_id().alias("rank")), "ranks")


_LAYOUT = "node string, start long, tree long, position long, ancestors array<struct<start:long,end:long>>"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole paths, sorted; gives the nodes a path owns their tree, position and ancestors' intervals."""
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    last, above, tree, position = None, [], 0, 0
    for batch in batches:
        rows = []
        for rank, node, start, size, own in rows_of(batch, ["rank", "node", "start", "size", "own"]):
            if rank != last:
                last, above, tree, position = rank, [], start, 0
            if own:
                rows.append((node, start, tree, position, [{"start": s, "end": e} for s, e in above]))
            position += size
            if above and above[-1][1] == start:
                above[-1] = (above[-1][0], start + size)
            else:
                above.append((start, start + size))
        columns = zip(*rows, strict=True) if rows else [[] for _ in types]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["node", "start", "tree", "position", "ancestors"])


def prefix_tree(conversations: DataFrame, tokenizer_path: str, loss_roles: frozenset[str] = LOSS_ROLES) -> tuple[DataFrame, DataFrame]:
    """The tree's nodes, and the conversations' places in it.

    ``conversations(conv_id, turn, role, text)`` has a row per turn; null roles and texts are
    empty, null conv_ids one conversation. Nodes: ``node, parent, tokens, loss_start, loss_end``
    (the node's tokens under the loss mask), ``start`` (of its first token in the layout of all
    trees), ``tree`` (start of its root), ``position`` (id of its first token), ``size`` and
    ``ancestors`` (the ``start, end`` intervals to attend to, adjoining ones merged). Places:
    ``conv, conv_id, n, node``, one row per turn. No conversations give no nodes.
    """
    turns = materialized(linked_turns(conversations, tokenizer_path, loss_roles), "turns")
    sized = turns.select("conv", "n", "node", F.size("tokens").cast("long").alias("size"))
    ranked = sized.join(_ranks(turns), "conv").select("rank", "n", "node", "size")
    # Passing conversations combine before the shuffle, so a node that many share is no burden.
    owned = ranked.groupBy("node").agg(F.min("rank").alias("owner"), F.first("n").alias("n"), F.first("size").alias("size"))
    owned = materialized(owned.withColumn("part", F.shiftright("owner", 33)), "owned")

    # Running sums: within the parts of the sorted order, and over the totals of the parts.
    totals = owned.groupBy("part").agg(F.sum("size").alias("total")).orderBy("part").collect()
    bases, base = [], 0
    for part, total in totals:
        bases.append((part, base))
        base += total
    bases = owned.sparkSession.createDataFrame(bases, "part long, base long")
    so_far = Window.partitionBy("part").orderBy("owner", "n")
    start = F.col("base") + F.sum("size").over(so_far) - F.col("size")
    starts = owned.join(F.broadcast(bases), "part").select("node", "owner", start.alias("start"))
    starts = materialized(starts, "starts")

    path = ranked.join(starts, "node").withColumn("own", F.col("rank") == F.col("owner"))
    walked = path.repartition("rank").sortWithinPartitions("rank", "n").select("rank", "node", "start", "size", "own")
    layout = materialized(walked.mapInArrow(_walk, _LAYOUT), "layout")
    # All turns of a node have the same parent and tokens; these are shuffled here and nowhere before.
    distinct = turns.groupBy("node").agg(*[F.first(c).alias(c) for c in ("parent", "tokens", "loss_start", "loss_end")])
    nodes = distinct.withColumn("size", F.size("tokens").cast("long")).join(layout, "node")
    return materialized(nodes, "nodes"), turns.select("conv", "conv_id", "n", "node")


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(tokenizer_path: str):
    types = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in DIGESTS.split(", ")]

    def batch_of(rows):
        columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
        return pa.RecordBatch.from_arrays([pa.array(list(c), types[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = decoder(tokenizer_path)
        last, state = None, None
        for batch in batches:
            rows = []
            for conv, conv_id, tokens, start, end in rows_of(batch, ["conv", "conv_id", "tokens", "loss_start", "loss_end"]):
                if conv != last:
                    if state:
                        rows.append(state.row())
                    last, state = conv, _Digest(conv_id)
                state.add(decode(tokens), decode(tokens[start:end]))
            yield batch_of(rows)
        if state:
            yield batch_of([state.row()])

    return read


class _Digest:
    """What is read back of one conversation; hashes grow turn by turn."""

    def __init__(self, conv_id):
        self._conv_id, self._turns, self._loss_chars, self._chars = conv_id, 0, 0, 0
        self._all, self._loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, loss: str) -> None:
        role, text = parse_turn(segment)
        masked = unescape(loss)
        self._turns += 1
        self._chars += len(segment)
        self._loss_chars += len(masked)
        self._all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self._loss.update(masked.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self._conv_id, self._turns, self._all.hexdigest(), self._loss_chars, self._loss.hexdigest(), self._chars


def read_back(nodes: DataFrame, places: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of every conversation, from the tokens of its nodes along its path.

    Null conv_ids are one conversation; empty tables give an empty result.
    """
    rows = places.join(nodes.select("node", "tokens", "loss_start", "loss_end"), "node")
    rows = rows.repartition("conv").sortWithinPartitions("conv", "n").select("conv", "conv_id", "tokens", "loss_start", "loss_end")
    return rows.mapInArrow(_read_back(tokenizer_path), DIGESTS)
