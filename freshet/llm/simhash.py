"""SimHash fingerprints and near-duplicate groups by covering locality-sensitive hashing.

Every bit of a fingerprint gets a non-zero vector of ``radius + 1`` bits. Each non-zero
vector ``v`` names one table, whose mask holds the bits whose vector has an odd product
with ``v``. The vectors of at most ``radius`` differing bits cannot span the space, so
some ``v`` is orthogonal to them all: in that table the two fingerprints agree on the whole
mask. Two fingerprints within the radius hence share a bucket of some table, with certainty.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.common import hashable_columns, materialized, utf8
from freshet.llm.components import components

BITS = 64
SEED = 42
RADIUS = 3
SHINGLE_WORDS = 3

#: Bucket members one task compares; larger buckets take the distributed path.
BUCKET_MEMBERS = 16_384
_UNPACKED_ROWS = 1 << 16


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words; bit set if in over half the shingles."""
    tokens = utf8(text).lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(words, len(tokens))
    spans = zip(starts[: len(tokens) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _UNPACKED_ROWS):
        part = hashes[start : start + _UNPACKED_ROWS].view(np.uint8).reshape(-1, BITS // 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def _fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for array in texts:
        values = (simhash(t.as_py()) for t in array)
        yield pa.array(np.fromiter(values, np.uint64, len(array)).view(np.int64))


def fingerprint(text: Column | str) -> Column:
    """Fingerprint of a text as a long with the same 64 bits; null and wordless texts give 0."""
    return _fingerprints(text)


def fingerprint_hex(value: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(value)), BITS // 4, "0")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks, as signed 64-bit numbers; ``2 ** (radius + 1) - 1`` of them."""
    vectors = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, vectors + 1):
        mask = sum(1 << bit for bit in range(BITS) if (bit % vectors + 1 & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> BITS - 1 else mask)
    return masks


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # Of a signed number numpy would count the bits of its absolute value.
    return np.bitwise_count((a ^ b).view(np.uint64))


def _spanning_links(members: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what pairs within the radius connect: a forest, not all pairs."""
    links, rest = [], members
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            head = queue.pop()
            near = _distance(rest, head) <= radius
            found, rest = rest[near], rest[~near]
            if len(found):
                links.append((np.full(len(found), head), found))
                queue.extend(found)
    return links


def _bucket_links(radius: int, limit: int):
    """Reads rows sorted by (tab, key); gives links, or the members of buckets over the limit."""
    schema = pa.schema([("tab", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def out(tab, a, b):
        columns = [pa.array(np.broadcast_to(np.asarray(x), np.shape(a)).astype(t)) for x, t in ((tab, "i4"), (a, "i8"), (b, "i8"))]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3  # the last bucket so far, it may go on in the next batch
        flooded = None  # a bucket over the limit, whose members stream through
        for batch in batches:
            tab, key, fp = (np.concatenate([h, batch.column(c).to_numpy().astype(np.int64)]) for h, c in zip(held, ("tab", "key", "fp"), strict=True))
            if not len(tab):
                continue
            edges = np.flatnonzero((tab[1:] != tab[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], edges, [len(tab)]])
            if flooded == (tab[0], key[0]):
                yield out(tab[0], fp[: starts[1]], fp[: starts[1]])
                tab, key, fp, starts = tab[starts[1] :], key[starts[1] :], fp[starts[1] :], starts[1:] - starts[1]
            elif starts[1] > limit:
                flooded = (tab[0], key[0])
                yield out(tab[0], fp[: starts[1]], fp[: starts[1]])
                tab, key, fp, starts = tab[starts[1] :], key[starts[1] :], fp[starts[1] :], starts[1:] - starts[1]
            if len(starts) < 2:
                held = [np.empty(0, np.int64)] * 3
                continue
            yield from closed(tab, fp, starts[:-1])
            held = [x[starts[-2] :] for x in (tab, key, fp)]
            if len(held[0]) > limit:
                flooded = (held[0][0], held[1][0])
                yield out(held[0][0], held[2], held[2])
                held = [np.empty(0, np.int64)] * 3
        if len(held[0]):
            yield from closed(held[0], held[2], np.array([0, len(held[0])]))

    def closed(tab, fp, starts):
        """Buckets [starts[i], starts[i + 1]); each is whole."""
        sizes = np.diff(starts)
        first = starts[:-1][sizes == 2]
        a, b = fp[first], fp[first + 1]
        near = _distance(a, b) <= radius
        if near.any():
            yield out(-1, a[near], b[near])
        for i in np.flatnonzero(sizes > 2):
            if sizes[i] > limit:
                members = fp[starts[i] : starts[i + 1]]
                yield out(tab[starts[i]], members, members)
                continue
            for a, b in _spanning_links(fp[starts[i] : starts[i + 1]], radius):
                yield out(-1, a, b)

    return search


def _crowded_links(crowded: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links within buckets of any size: members meet at common neighbours.

    Two members at distance d <= radius have a point c between them, at most
    ``radius // 2`` from one and ``radius - radius // 2`` from the other. Each member names all
    points that near, changing only bits outside the table's mask. At each point the least
    of the nearer members is tied to all that came there. A point has at most as many
    members as there are patterns (a few hundred), whatever the bucket's size.
    """
    spark = crowded.sparkSession
    inner, outer = radius // 2, radius - radius // 2
    patterns = []
    for tab, mask in enumerate(masks):
        free = [bit for bit in range(BITS) if not mask >> bit & 1]
        level = {0}
        known = {0: 0}
        for distance in range(1, outer + 1):
            level = {p ^ 1 << bit for p in level for bit in free} - known.keys()
            known |= dict.fromkeys(level, distance)
        patterns += [(tab, p - (1 << BITS) if p >> BITS - 1 else p, d) for p, d in known.items()]
    points = spark.createDataFrame(patterns, "tab int, pattern long, distance int")
    met = crowded.join(F.broadcast(points), "tab").select(
        "tab", F.col("a").bitwiseXOR(F.col("pattern")).alias("point"), "a", "distance"
    )
    at_point = met.groupBy("tab", "point").agg(
        F.min(F.when(F.col("distance") <= inner, F.col("a"))).alias("least"), F.collect_set("a").alias("members")
    )
    return at_point.where("least is not null").select(F.col("least").alias("a"), F.explode("members").alias("b"))


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, bucket_members: int = BUCKET_MEMBERS) -> DataFrame:
    """Links ``a, b`` between different fingerprints within the radius, enough to connect all such pairs.

    ``distinct`` has one row per fingerprint in ``fp``. Every link is a true one. A bucket
    is compared in one task up to ``bucket_members`` and through common neighbours beyond,
    so no pair is lost at any size.
    """
    masks = covering_masks(radius)
    keyed = [F.struct(F.lit(i).alias("tab"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    rows = distinct.select("fp", F.explode(F.array(*keyed)).alias("_")).select("_.tab", "_.key", "fp")
    rows = rows.repartition("tab", "key").sortWithinPartitions("tab", "key")
    found = materialized(rows.mapInArrow(_bucket_links(radius, bucket_members), "tab int, a long, b long"), "bucket-links")
    links = found.where("tab < 0").select("a", "b")
    crowded = found.where("tab >= 0").select("tab", "a")
    if not crowded.isEmpty():
        links = links.unionByName(_crowded_links(crowded, masks, radius))
    return links


def near_duplicate_groups(docs: DataFrame, radius: int = RADIUS, bucket_members: int = BUCKET_MEMBERS) -> DataFrame:
    """``fp, component_id, keeper_fp, keeper_rows`` per distinct fingerprint of ``docs(doc_id, fp)``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius`` bits
    (null doc_ids count only where a component has no other), ``keeper_fp`` the fingerprint
    of that document, and ``keeper_rows`` how many rows carry this pair. Copies are one
    node: rows combine before their shuffle.
    """
    ids = docs.groupBy("fp", "doc_id").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "fp", "n")
    groups = materialized(ids.groupBy("fp").agg(F.min(order).alias("first")), "fingerprints")
    nodes = components(fingerprint_links(groups.select("fp"), radius, bucket_members))
    rooted = groups.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    keepers = rooted.groupBy("root").agg(F.min("first").alias("keeper"))
    return rooted.join(keepers, "root").select(
        "fp",
        F.col("keeper.doc_id").alias("component_id"),
        F.col("keeper.fp").alias("keeper_fp"),
        F.col("keeper.n").alias("keeper_rows"),
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    Empty, null and wordless texts have fingerprint zero and are linked like any other.
    """
    rows = materialized(docs.select("doc_id", fingerprint("text").alias("fp")), "fingerprint-rows")
    groups = near_duplicate_groups(rows, radius)
    return rows.join(groups.select("fp", "component_id"), "fp").select(
        "doc_id", fingerprint_hex("fp").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group, all columns as they were.

    The document with the smallest doc_id stays; of rows with the same doc_id and fingerprint
    that of the least hashes of the text and of all columns, whatever the layout.
    """
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    rows = docs.select(row, F.col("doc_id").alias("id"), fingerprint("text").alias("fp"))
    rows = materialized(rows, "fingerprint-docs")
    groups = near_duplicate_groups(rows.select(F.col("id").alias("doc_id"), "fp"), radius)
    keepers = groups.where("fp = keeper_fp").select(
        F.col("fp").alias("keeper"), F.col("component_id").alias("keeper_id"), "keeper_rows"
    )
    # The doc_id in the join key spreads the copies of a hot fingerprint over the partitions.
    kept = rows.join(keepers, (rows.fp == keepers.keeper) & rows.id.eqNullSafe(keepers.keeper_id))
    single = kept.where("keeper_rows = 1").select("row.*")
    # Both branches take the same columns from the join's input, so that Spark shuffles it once.
    order = F.struct(F.xxhash64("row.text"), F.xxhash64(*hashable_columns(docs, "row")))
    tied = kept.where("keeper_rows > 1").groupBy("fp").agg(F.min_by("row", order).alias("row"))
    return single.unionByName(tied.select("row.*"))
