"""Removal of repeated word windows by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the leftmost of its runs of
``minimiser`` words with the least hash. Consecutive windows with the minimiser at the same
place travel as one packed string to the bucket of that minimiser, where equal windows
must meet: they have the same words and so the same minimiser. There the windows are named by
doubling (a name for each pair of words, of pairs, of fours, ...) and sorted, so
that words are compared, not hashes.

Strings of more than one window hold a window once only, as its minimiser has one place.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.common import materialized, rows_of, shuffles_cleared, utf8

WINDOW_WORDS = 20
MINIMISER_WORDS = 3

#: A minimiser that more than one in so many strings has is spread over buckets by whole windows.
HOT_SHARE = 1000
#: Passes over the texts; each sends the strings of its share of the buckets.
WAVES = 2
#: Windows of one minimiser that a task compares in memory; beyond that Spark sorts them.
BUCKET_WINDOWS = 2_000_000
#: Salt of the windows that Spark sorts.
_SALTS = 64
_CHUNK_TEXTS, _CHUNK_BYTES = 1000, 1_000_000

_STRINGS = "key long, packed binary, doc long, text_hash long, start long, windows long"
_STRING_SCHEMA = pa.schema([("key", pa.int64()), ("packed", pa.binary()), ("doc", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int64()), ("windows", pa.int64())])

_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: A random number for each byte at each of 64 places of a word.
_BYTES = np.random.default_rng(11).integers(0, 2**64, 64 * 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return hashes ^ (hashes >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


class _Hashes:
    """A hash of any run of words from the words' hashes, as a difference of two sums."""

    def __init__(self, words: np.ndarray):
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(_BASE, len(words)))])
        self.scale = _powers(_INVERSE, len(words) + 1)

    def of(self, first: np.ndarray, words) -> np.ndarray:
        return _mixed((self.sums[first + words] - self.sums[first]) * self.scale[first])


class _Words:
    """The words of some texts, joined by single spaces: place, size and hash of each, ``begins`` of each text."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        space = _SPACES[raw]
        follows = np.concatenate([[True], space[:-1]])
        starts = np.flatnonzero(~space & follows)
        ends = np.flatnonzero(space & ~follows)
        self.begins = np.searchsorted(starts, np.cumsum(sizes) - sizes)
        self.counts = np.diff(self.begins, append=len(starts))
        joined = np.where(space, np.uint8(32), raw)[~space | ~follows]
        self.joined = joined.tobytes()
        self.sizes = ends - starts
        self.places = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.hashes = np.empty(len(starts), np.uint64)
        for low in range(0, len(starts), 65_536):  # few bytes at a time, as each takes several numbers
            places, lengths = self.places[low : low + 65_536], self.sizes[low : low + 65_536] + 1
            part = joined[places[0] : places[-1] + lengths[-1]]
            inside = np.arange(len(part)) - np.repeat(places - places[0], lengths)
            self.hashes[low : low + 65_536] = np.add.reduceat(_BYTES[(inside & 63) << 8 | part], places - places[0])
        self.hashes = _mixed(self.hashes)


def _least(values: np.ndarray, width: int, n: int) -> np.ndarray:
    """Place of the first least value in each of ``n`` stretches of ``width``."""
    best, place = values[:n].copy(), np.zeros(n, np.int64)
    for i in range(1, width):
        following = values[i : i + n]
        less = following < best
        np.copyto(best, following, where=less)
        place[less] = i
    return place


class _Chunk:
    """Super-k-mers of some texts: ``first`` word, number of ``windows``, ``key`` and ``owner``."""

    def __init__(self, texts: list[bytes], window: int, minimiser: int):
        self.window, self.words = window, _Words(texts)
        self.runs = _Hashes(self.words.hashes)
        begins, counts = self.words.begins, self.words.counts
        n = max(0, len(self.words.hashes) - window + 1)
        owner = np.repeat(np.arange(len(texts)), counts)[:n]
        hashes = self.runs.of(np.arange(max(0, len(self.words.hashes) - minimiser + 1)), minimiser)
        where = np.arange(n) + _least(hashes, window - minimiser + 1, n)
        whole = np.arange(n) + window <= (begins + counts)[owner]
        new = whole.copy()
        new[1:] &= (where[1:] != where[:-1]) | ~whole[:-1]
        self.first = np.flatnonzero(new)
        self.windows = np.bincount(np.cumsum(new)[whole], minlength=len(self.first) + 1)[1:]
        self.key = hashes[where[self.first]].view(np.int64)
        self.owner = owner[self.first]

    def choose(self, chosen: np.ndarray) -> None:
        self.first, self.windows, self.key, self.owner = (x[chosen] for x in (self.first, self.windows, self.key, self.owner))

    def split(self, hot: np.ndarray) -> None:
        """Strings of hot minimisers give way to single windows, each with a key of its own."""
        single = np.isin(self.key, hot)
        times = np.where(single, self.windows, 1)
        self.choose(np.repeat(np.arange(len(times)), times))
        single = np.repeat(single, times)
        self.first = self.first + np.arange(len(single)) - np.repeat(np.cumsum(times) - times, times)
        self.windows = np.where(single, 1, self.windows)
        self.key = np.where(single, self.runs.of(self.first, self.window).view(np.int64), self.key)

    def packed(self) -> list[bytes]:
        last = self.first + self.windows + self.window - 2
        ends = self.words.places[last] + self.words.sizes[last]
        return [self.words.joined[a:b] for a, b in zip(self.words.places[self.first].tolist(), ends.tolist(), strict=True)]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of bounded size, but for single texts."""
    start, size = 0, 0
    for i, length in enumerate(pc.binary_length(batch.column("text")).fill_null(0).to_pylist()):
        if i > start and (i - start == _CHUNK_TEXTS or size + length > _CHUNK_BYTES):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += length
    if start < batch.num_rows:
        yield batch.slice(start)


def _bytes(part: pa.RecordBatch) -> list[bytes]:
    return part.column("text").cast(pa.binary()).fill_null(b"").to_pylist()


def _frequent(window: int, minimiser: int, share: int):
    """Counts of a task's minimisers, less at most one ``2 * share``th of all; null counts all."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, keys, counts = 0, np.empty(0, np.int64), np.empty(0, np.int64)
        for part in (p for b in batches for p in _parts(b)):
            seen, n = np.unique(_Chunk(_bytes(part), window, minimiser).key, return_counts=True)
            total += int(n.sum())
            both, place = np.unique(np.concatenate([keys, seen]), return_inverse=True)
            sums = np.zeros(len(both), np.int64)
            np.add.at(sums, place, np.concatenate([counts, n]))
            if len(both) > 2 * share:
                sums -= np.partition(sums, -2 * share - 1)[-2 * share - 1]
            keys, counts = both[sums > 0], sums[sums > 0]
        yield pa.RecordBatch.from_arrays([pa.array([*keys.tolist(), None], pa.int64()), pa.array([*counts.tolist(), total], pa.int64())], schema=schema)

    return tally


def hot_minimisers(docs: DataFrame, window: int, minimiser: int, share: int) -> list[int]:
    """All minimisers of more than one string in ``share``, and a few below; at most ``2 * share``.

    Tasks count with ``2 * share`` counters each, so that what reaches the driver is bounded.
    """
    counts = docs.select("text").mapInArrow(_frequent(window, minimiser, share), "key long, n long")
    most = counts.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("key")).limit(2 * share + 1).collect()
    total = sum(r["n"] for r in most if r["key"] is None)
    return [r["key"] for r in most if r["key"] is not None and 2 * share * r["n"] >= total]


def _combined(chunk: _Chunk, packed: list[bytes], known: np.ndarray, doc: np.ndarray, text_hash: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which strings travel, and which repeat an earlier equal one of the chunk; others equal one that travels."""
    travel, repeat = np.ones(len(packed), bool), np.zeros(len(packed), bool)
    name = chunk.runs.of(chunk.first, chunk.windows + chunk.window - 1)
    order = np.lexsort((start, doc, known, name))
    new = np.concatenate([[True], name[order][1:] != name[order][:-1]])
    heads = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    for i, head in zip(order[~new].tolist(), heads[~new].tolist(), strict=True):
        if packed[i] != packed[head]:
            continue
        if (known[i], doc[i], start[i]) != (known[head], doc[head], start[head]):
            travel[i], repeat[i] = False, True
        elif text_hash[i] == text_hash[head]:
            travel[i] = False
    return travel, repeat


def _strings(window: int, minimiser: int, hot: list[int], wave: int, waves: int):
    """Packed strings of a wave with their buckets; a row without a string is a repeat that the task saw itself.

    Equal strings of a chunk are combined: the earliest travels, the others are repeats.
    """
    hot_keys = np.array(hot, np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in _parts(b)):
            chunk = _Chunk(_bytes(part), window, minimiser)
            chunk.split(hot_keys)
            chunk.choose((chunk.key.view(np.uint64) >> np.uint64(20)) % np.uint64(waves) == wave)
            if not len(chunk.first):
                continue
            known = part.column("doc").is_valid().to_numpy(zero_copy_only=False)[chunk.owner]
            doc = part.column("doc").fill_null(0).to_numpy()[chunk.owner]
            text_hash = part.column("text_hash").to_numpy()[chunk.owner]
            start = chunk.first - chunk.words.begins[chunk.owner]
            packed = chunk.packed()
            travel, repeat = _combined(chunk, packed, known, doc, text_hash, start)
            sent = np.flatnonzero(travel | repeat)
            strings = pa.array([packed[i] if goes else None for i, goes in zip(sent.tolist(), travel[sent].tolist(), strict=True)], pa.binary())
            # Repeats go along to any bucket.
            keys = np.where(travel, chunk.key, text_hash ^ start)
            columns = [pa.array(keys[sent]), strings, pa.array(doc[sent], mask=~known[sent]), pa.array(text_hash[sent]), pa.array(start[sent]), pa.array(chunk.windows[sent])]
            yield pa.RecordBatch.from_arrays(columns, schema=_STRING_SCHEMA)

    return pack


def _names(words: np.ndarray, window: int) -> np.ndarray:
    """Equal numbers for equal runs of ``window`` words: names of runs twice as long, step by step."""
    width, names = 1, words
    while width < window:
        step = min(width, window - width)
        pairs = names[:-step] * (int(names.max(initial=0)) + 1) + names[step:]
        names = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        width += step
    return names


class _Windows:
    """The windows of some packed strings: their row, place in it, and first word among all words."""

    def __init__(self, rows: pa.RecordBatch, window: int):
        joined = b" ".join(rows.column("packed").to_pylist()) + b" "
        ends = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + 1
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int64)).buffers()[1]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, offsets, pa.py_buffer(joined)])
        self.words = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        windows = rows.column("windows").to_numpy()
        sizes = windows + window - 1
        self.row = np.repeat(np.arange(len(windows)), windows)
        self.inside = np.arange(len(self.row)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.first = np.repeat(np.cumsum(sizes) - sizes, windows) + self.inside


def _later(rows: pa.RecordBatch, window: int) -> list[np.ndarray]:
    """Row, first window and number of windows of every run of windows that start earlier elsewhere."""
    key = rows.column("key").to_numpy()
    same = key[1:] == key[:-1]
    chosen = np.zeros(len(key), bool)
    chosen[1:] = same
    chosen[:-1] |= same
    chosen = np.flatnonzero(chosen & rows.column("packed").is_valid().to_numpy(zero_copy_only=False))
    if not len(chosen):
        return [np.empty(0, np.int64)] * 3
    # Strings none of whose windows shares a hash need no names.
    every = _Windows(rows.take(pa.array(chosen)), window)
    hashes = _Hashes(_mixed(every.words.astype(np.uint64) + np.uint64(1))).of(every.first, window)
    shared, place = np.unique(hashes, return_inverse=True)
    often = np.bincount(place, minlength=len(shared))[place] > 1
    chosen = chosen[np.unique(every.row[often])]
    if not len(chosen):
        return [np.empty(0, np.int64)] * 3
    some = rows.take(pa.array(chosen))
    found = _Windows(some, window)
    row, inside = found.row, found.inside
    name = _names(found.words, window)[found.first]
    known = some.column("doc").is_valid().to_numpy(zero_copy_only=False)[row]
    doc = some.column("doc").fill_null(0).to_numpy()[row]
    start = some.column("start").to_numpy()[row] + inside
    order = np.lexsort((start, doc, known, name))
    name, known, doc, start = name[order], known[order], doc[order], start[order]
    first = np.concatenate([[True], name[1:] != name[:-1]])
    least = np.flatnonzero(first)[np.cumsum(first) - 1]
    later = np.zeros(len(row), bool)
    later[order] = (known != known[least]) | (doc != doc[least]) | (start != start[least])
    begins = later.copy()
    begins[1:] &= ~later[:-1] | (row[1:] != row[:-1])
    lengths = np.bincount(np.cumsum(begins)[later], minlength=int(begins.sum()) + 1)[1:]
    return [chosen[row[begins]], inside[begins], lengths]


def _repeats(window: int, limit: int):
    """Reads strings sorted by bucket key; gives the repeats, and single windows of floods.

    A flood is a bucket key with more windows than the limit: its windows are handed on.
    """
    empty = pa.RecordBatch.from_pylist([], _STRING_SCHEMA)

    def done(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seen = rows.filter(rows.column("packed").is_null())
        if seen.num_rows:
            yield seen
        row, offset, lengths = _later(rows, window)
        if len(row):
            some = rows.take(pa.array(row))
            columns = [some.column("key"), pa.nulls(len(row), pa.binary()), some.column("doc"), some.column("text_hash")]
            columns += [pa.array(some.column("start").to_numpy() + offset), pa.array(lengths)]
            yield pa.RecordBatch.from_arrays(columns, schema=_STRING_SCHEMA)

    def singles(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in (rows.slice(i, 500) for i in range(0, rows.num_rows, 500)):
            out = []
            for r in part.to_pylist():
                words = (r["packed"] or b"").split(b" ")
                for i in range(len(words) - window + 1):
                    out.append(r | {"packed": b" ".join(words[i : i + window]), "start": r["start"] + i, "windows": 1})
                if r["packed"] is None:
                    out.append(r)
            yield pa.RecordBatch.from_pylist(out, _STRING_SCHEMA)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, flooded = empty, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([held, batch.cast(_STRING_SCHEMA)]).combine_chunks().to_batches()[0]
            key = rows.column("key").to_numpy()
            if flooded == key[0]:
                end = int(np.searchsorted(key, key[0], side="right"))
                yield from singles(rows.slice(0, end))
                rows, key = rows.slice(end), key[end:]
                if not len(key):
                    held = empty
                    continue
            flooded = None
            last = int(np.searchsorted(key, key[-1]))
            yield from done(rows.slice(0, last))
            held = rows.slice(last)
            if pc.sum(held.column("windows")).as_py() > limit:
                flooded = int(key[-1])
                yield from singles(held)
                held = empty
        yield from done(held)

    return search


def _flood_repeats(marks: DataFrame) -> DataFrame:
    """Repeats among single windows, first within a salt and then among the earliest of each."""
    order = F.struct(F.col("doc").isNotNull(), F.coalesce("doc", F.lit(0)), "start")
    floods = marks.where("packed is not null").withColumns({"at": order, "salt": F.pmod(F.xxhash64("doc", "start"), F.lit(_SALTS))})
    salted = materialized(floods.withColumn("least", F.min("at").over(Window.partitionBy("packed", "salt"))), "windows")
    ends = salted.where("at = least").withColumn("least", F.min("at").over(Window.partitionBy("packed")))
    return salted.where("at > least").unionByName(ends.where("at > least")).select("doc", "text_hash", "start", "windows")


def repeated_spans(
    docs: DataFrame,
    window: int = WINDOW_WORDS,
    minimiser: int = MINIMISER_WORDS,
    hot_share: int = HOT_SHARE,
    waves: int = WAVES,
    bucket_windows: int = BUCKET_WINDOWS,
) -> DataFrame:
    """``doc, text_hash, spans``: the word ranges ``start, end`` covered by windows that also start earlier.

    ``text_hash`` is ``xxhash64(text)`` and tells texts of one doc_id apart. One row for each
    document with such a window; a document's spans may overlap.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("text_hash"), "text")
    hot = hot_minimisers(texts, window, minimiser, hot_share)
    found = None
    with shuffles_cleared(docs.sparkSession):
        for wave in range(waves):
            strings = texts.mapInArrow(_strings(window, minimiser, hot, wave, waves), _STRINGS)
            buckets = strings.repartition("key").sortWithinPartitions("key")
            marks = materialized(buckets.mapInArrow(_repeats(window, bucket_windows), _STRINGS), f"repeats-{wave}")
            part = marks.where("packed is null").select("doc", "text_hash", "start", "windows").unionByName(_flood_repeats(marks))
            found = part if found is None else found.unionByName(part)
        span = F.struct("start", (F.col("start") + F.col("windows") + (window - 1)).alias("end"))
        return materialized(found.distinct().groupBy("doc", "text_hash").agg(F.collect_list(span).alias("spans")), "spans")


_CUT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("kept", T.StringType()),
])
_CUT_TYPE = pa.struct([
    ("n_words", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("kept", pa.string()),
])


def cut(text: str | None, spans: list[dict] | None) -> dict:
    """The text's words outside the spans, joined by a space, and the spans joined where they touch."""
    words, removed, kept, at = utf8(text).split(), [], [], 0
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if removed and start <= removed[-1]["end"]:
            removed[-1]["end"] = max(end, removed[-1]["end"])
        else:
            removed.append({"start": start, "end": end})
    for span in removed:
        kept += words[at : span["start"]]
        at = span["end"]
    kept += words[at:]
    return {"n_words": len(words), "removed": removed, "kept": b" ".join(kept).decode("utf-8", "surrogatepass")}


@F.arrow_udf(_CUT)
def _cuts(texts: pa.Array, spans: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([texts, spans], ["text", "spans"])
    return pa.array([cut(text, ranges) for text, ranges in rows_of(batch, ["text", "spans"])], _CUT_TYPE)


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``row, n_words, n_removed, removed, kept`` for every row of ``docs``; ``row`` has all its columns.

    Words are the runs without ASCII white space. A word goes if it is in a window whose
    words also start earlier: in a document of smaller doc_id, or further ahead in its own.
    ``removed`` has the word ranges that go, ``kept`` the other words joined by one space.
    ``options`` are those of ``repeated_spans``.

    Null texts have no words. Null doc_ids are one number, before all others. Rows of equal
    doc_id count as one document: places of equal words and equal start are not earlier than
    each other, so rows equal in doc_id and text get equal results. Texts of fewer words than
    a window stay whole. An empty table gives an empty result.
    """
    spans = repeated_spans(docs, **options)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row).withColumns({"doc_key": F.col("row.doc_id").cast("long"), "hash_key": F.xxhash64("row.text")})
    joined = rows.join(spans, rows["doc_key"].eqNullSafe(spans["doc"]) & (rows["hash_key"] == spans["text_hash"]), "left")
    cuts = joined.select("row", _cuts("row.text", "spans").alias("cut"))
    lengths = F.transform("cut.removed", lambda s: s["end"] - s["start"])
    n_removed = F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n).alias("n_removed")
    return cuts.select("row", "cut.n_words", n_removed, "cut.removed", "cut.kept")
