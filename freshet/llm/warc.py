"""WARC archives of captured pages, and one global index of them by external merging.

Writing: each task streams its pages into gzip-per-record WARC files in a shared folder;
equal payloads are stored once and revisited. Indexing: each archive is read back record by
record into a run sorted by URL key and timestamp, and the runs are written. One range
exchange by the same key brings the stretches of all runs that belong together into a
task, where a loser tree merges them. The tasks' outputs follow one another in the global order.
"""

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import materialized, rows_of
from freshet.session import scratch_path

REVISIT_BYTES = 1000
#: A new archive begins after so many bytes or records; a run has as many records at most.
ARCHIVE_BYTES = 64_000_000
RUN_RECORDS = 100_000
READ_BYTES = 1 << 20
#: Payloads with copies are broadcast up to this many (some 100 bytes each), and joined by a shuffle beyond.
BROADCAST_PAYLOADS = 500_000
#: Index rows of a range, on average: what one task merges in memory, some 200 MB.
RANGE_ROWS = 200_000
#: Archives are read by at most so many tasks.
READ_TASKS = 100_000

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTENT_TYPE = "application/http;msgtype=response"

_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def page_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def warc_date(moment: datetime | None) -> str:
    """UTC to the second; a missing time is the epoch."""
    if moment is None:
        moment = datetime.fromtimestamp(0, UTC)
    elif moment.tzinfo is not None:
        moment = moment.astimezone(UTC)
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id, url, captured_at: datetime | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit has the HTTP headers of the full response and no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": page_uri(page_id),
        "WARC-Date": warc_date(captured_at),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type": CONTENT_TYPE,
        "Content-Length": len(block),
    }
    if url is not None:
        # A URL has no control characters or spaces; any are percent-encoded, for they would break the header.
        fields["WARC-Target-URI"] = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
    if revisit:
        fields |= {"WARC-Refers-To": page_uri(refers_to), "WARC-Profile": REVISIT_PROFILE}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"{VERSION}\r\n{head}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Header fields, the payload's full length, and the payload (empty for a revisit)."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields.get("Content-Length", -1))
    block = rest[: max(length, 0)]
    if version != VERSION or not found or len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("broken WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    if fields["WARC-Type"] == "response":
        digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if len(payload) != declared or digest != fields["WARC-Payload-Digest"]:
            raise ValueError("payload does not match its digest or length")
    return fields, declared, payload


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """Offset, compressed length and content of each gzip member of a stream."""
    offset, waiting = 0, b""
    while waiting or (waiting := stream.read(READ_BYTES)):
        member, parts, used = zlib.decompressobj(31), [], 0
        while not member.eof:
            if not waiting and not (waiting := stream.read(READ_BYTES)):
                raise ValueError("archive ends inside a record")
            parts.append(member.decompress(waiting))
            used += len(waiting) - len(member.unused_data)
            waiting = member.unused_data
        yield offset, used, b"".join(parts)
        offset += used


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, then path and query; the fragment, scheme and default port do not count."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    place = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{place}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, the root the winner."""

    def __init__(self, runs: list[list]):
        self._runs, self._at, k = runs, [0] * len(runs), len(runs)
        self._losers = [-1] * max(1, k)
        for run in range(k):
            self._play(run)

    def _beats(self, a: int, b: int) -> bool:
        if self._at[a] == len(self._runs[a]):
            return False
        if self._at[b] == len(self._runs[b]):
            return True
        x, y = self._runs[a][self._at[a]], self._runs[b][self._at[b]]
        return x < y or (x == y and a < b)

    def _play(self, run: int) -> None:
        """Lets a run climb from its leaf; while the tree fills, it waits at the first empty node."""
        node = (run + len(self._runs)) // 2
        while node > 0:
            if self._losers[node] == -1:
                self._losers[node] = run
                return
            if self._beats(self._losers[node], run):
                self._losers[node], run = run, self._losers[node]
            node //= 2
        self._losers[0] = run

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """Pairs of run and place in it, in merged order; equal keys come in the order of the runs."""
        while self._runs:
            winner = self._losers[0]
            if self._at[winner] == len(self._runs[winner]):
                return
            yield winner, self._at[winner]
            self._at[winner] += 1
            self._play(winner)


def _write(root: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(root)
        system.create_dir(folder, recursive=True)
        context, name, out, size = TaskContext.get(), None, None, 0
        written = []
        for batch in batches:
            for page_id, url, html, captured_at, digest, refers_to in rows_of(batch, ["page_id", "url", "html", "captured_at", "digest", "refers_to"]):
                if out is None:
                    # A repeated attempt writes files of its own; only those of the successful one get listed.
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(written):04d}.warc.gz"
                    out, size = system.open_output_stream(f"{folder}/{name}", compression=None), 0
                payload = (html or "").encode("utf-8", "surrogatepass")
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(record(page_id, url, captured_at, payload, digest, refers_to)) + packer.flush()
                out.write(data)
                size += len(data)
                if size >= archive_bytes:
                    out.close()
                    written.append((name, size))
                    out = None
        if out is not None:
            out.close()
            written.append((name, size))
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in written], pa.string()), pa.array([s for _, s in written], pa.int64())], names=["file", "bytes"])

    return write


def write_archives(captures: DataFrame, root: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of ``captures(page_id, url, html, captured_at)``; lists the archives' ``file, bytes``.

    The payload is the html in UTF-8 (null: empty). Of the records with equal payloads of at
    least 1000 bytes those with the largest page_id are responses and the others revisit
    it; records without page_id revisit too, unless none of the group has one.
    """
    rows = captures.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), "captured_at")
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    stored = (
        rows.where(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("stored"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "stored")
    )
    stored = materialized(stored, "stored-payloads")
    if stored.limit(BROADCAST_PAYLOADS + 1).count() <= BROADCAST_PAYLOADS:
        stored = F.broadcast(stored)
    marked = rows.join(stored, "digest", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("stored")), F.col("stored")))
    return materialized(marked.mapInArrow(_write(root, archive_bytes), "file string, bytes long"), "archives")


INDEX = {
    "url_key": pa.string(),
    "captured_at": pa.string(),
    "page_id": pa.int64(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "file": pa.string(),
    "offset": pa.int64(),
    "length": pa.int64(),
}
INDEX_DDL = ", ".join(f"{name} {'long' if kind == pa.int64() else 'string'}" for name, kind in INDEX.items())
KEY = ["url_key", "captured_at", "page_id"]
#: Repeated records have equal keys; their places tell them apart, so that ranges can part them.
PLACE = ["file", "offset"]


def _sort_key(row: tuple) -> tuple:
    url, captured_at, page_id = row[:3]
    return url.encode("utf-8", "surrogatepass"), captured_at, page_id is not None, page_id or 0, row[7], row[8]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in INDEX]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, INDEX.values(), strict=True)], names=list(INDEX))


def _read(root: str, run_records: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                run = []
                with system.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for offset, length, data in members(stream):
                        fields, size, _ = parse_record(data)
                        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        run.append((url_key(fields.get("WARC-Target-URI")), fields["WARC-Date"], page_of(fields["WARC-Record-ID"]), size, digest,
                                    fields["WARC-Type"], page_of(fields.get("WARC-Refers-To")), name, offset, length))
                        if len(run) == run_records:
                            yield _batch(sorted(run, key=_sort_key))
                            run = []
                if run:
                    yield _batch(sorted(run, key=_sort_key))

    return read


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges what a range got from all runs; a stretch in order is one run, however it arrived."""
    runs: list[list[tuple]] = []
    last = None
    for batch in batches:
        for row in rows_of(batch, list(INDEX)):
            key = _sort_key(row)
            if last is None or key < last:
                runs.append([])
            runs[-1].append((key, row))
            last = key
    merged = LoserTree([[key for key, _ in run] for run in runs])
    out = []
    for run, place in merged:
        out.append(runs[run][place][1])
        if len(out) == 10_000:
            yield _batch(out)
            out = []
    yield _batch(out)


def capture_index(archives: DataFrame, root: str, run_records: int = RUN_RECORDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The global index of ``archives(file)`` below ``root``: all records by URL key, timestamp and page_id.

    Every record is read and its payload checked. The frame's partitions follow one another in
    order. There are as many ranges as the index has ``range_rows``, at least as many as shuffles have
    partitions. A URL with very many captures spans several ranges, as the timestamp is
    in the key, and so do records with equal keys, by their places in the archives.
    """
    tasks = min(READ_TASKS, max(1, archives.count()))
    files = archives.select("file").repartition(tasks, "file")
    runs = materialized(files.mapInArrow(_read(root, run_records), INDEX_DDL), "capture-runs")
    ranges = max(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // range_rows))
    return runs.repartitionByRange(ranges, *KEY, *PLACE).mapInArrow(_merge, INDEX_DDL)


def archive_and_index(captures: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the captures below the shared scratch folder, reads them back and gives their index."""
    root = scratch_path(captures.sparkSession, "warc")
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}"
    return capture_index(write_archives(captures, root, archive_bytes), root)


def dated(pages: DataFrame) -> DataFrame:
    """Captures of ``pages(page_id, url, html)``, which have no time: a second after the other, by page_id."""
    start = int(datetime(2024, 1, 1, tzinfo=UTC).timestamp())
    seconds = F.lit(start) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 30))
    return pages.select("page_id", "url", "html", F.timestamp_seconds(seconds).alias("captured_at"))
