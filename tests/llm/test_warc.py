import gzip
import hashlib
import io
import random
from datetime import UTC, datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.llm import warc

PAGES = "page_id long, url string, html string"


@given(st.lists(st.lists(st.integers(0, 30)).map(sorted), max_size=9))
def test_loser_tree_merges(runs):
    merged = [(runs[r][i], r, i) for r, i in warc.LoserTree(runs)]
    assert merged == sorted((x, r, i) for r, run in enumerate(runs) for i, x in enumerate(run))


@given(st.binary(max_size=60), st.text(max_size=20), st.booleans())
def test_record_round_trip(payload, url, revisit):
    digest = hashlib.sha1(payload).hexdigest()
    data = warc.record(5, url, datetime(2024, 1, 2, tzinfo=UTC), payload, digest, 9 if revisit else None)
    fields, size, back = warc.parse_record(data)
    assert size == len(payload) and back == (b"" if revisit else payload)
    assert warc.page_of(fields["WARC-Record-ID"]) == 5 and warc.page_of(fields.get("WARC-Refers-To")) == (9 if revisit else None)
    with pytest.raises(ValueError):
        warc.parse_record(data[:-1])


def test_damage_is_found():
    data = warc.record(5, "u", None, b"abcdef", hashlib.sha1(b"abcdef").hexdigest(), None)
    with pytest.raises(ValueError):
        warc.parse_record(data.replace(b"abcdef", b"abcdeg"))
    packed = gzip.compress(data) + gzip.compress(data)
    assert [d for _, _, d in warc.members(io.BytesIO(packed))] == [data, data]
    offsets = [(o, n) for o, n, _ in warc.members(io.BytesIO(packed))]
    assert gzip.decompress(packed[offsets[1][0] : sum(offsets[1])]) == data
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(packed[:-3])))


def test_url_keys():
    assert warc.url_key("https://www.Example.com:443/A?b=1#c") == "com,example)/A?b=1"
    assert warc.url_key("http://m.example.org:8080") == "org,example,m:8080)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[broken") == "http://[broken"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    big = ["<p>" + c * 1200 for c in "abc"]
    rows = [(i, f"http://h{rng.randrange(9)}.example/{rng.randrange(4)}", rng.choice([*big, f"small {i % 3}", f"<b>{i}" * 400])) for i in range(300)]
    rows += [(1000, None, None), (1001, "", ""), (1002, "u r\nl", "né\r\n\r\nx" * 300), (None, "http://x/", big[0]), (None, "http://x/", "z" * 2000), (None, "http://x/", "z" * 2000)]
    rows += [(7, rows[7][1], rows[7][2]), (2000, "http://h.example/long", "long " * 200_000)]
    return rows


def expected(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        stored = max(same, default=None) if len(payload) >= 1000 else page_id
        refers = stored if stored != page_id else None
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("archive_bytes, broadcast", [(3_000, 500_000), (64_000_000, 0)])
def test_index_of_archives(spark, rows, archive_bytes, broadcast, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", broadcast)
    pages = spark.createDataFrame(rows, PAGES).repartition(3).withColumn("digest", F.lit("clash"))
    index = warc.archive_and_index(warc.dated(pages), archive_bytes)
    found = index.collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found), key=repr) == expected(rows)
    keys = [(r["url_key"].encode(), r["captured_at"], r["page_id"] is not None, r["page_id"] or 0) for r in found]
    assert keys == sorted(keys)


def test_runs_of_any_size_give_one_order(spark, rows):
    pages = warc.dated(spark.createDataFrame(rows[:60], PAGES).repartition(2))
    root = f"file://{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/warc-runs"
    archives = warc.write_archives(pages, root, 20_000)
    want = warc.capture_index(archives, root).drop("file").collect()
    assert warc.capture_index(archives, root, run_records=3).drop("file").collect() == want


def test_no_pages(spark):
    assert warc.archive_and_index(warc.dated(spark.createDataFrame([], PAGES))).count() == 0


def test_ranges_are_bounded_and_part_equal_records(spark):
    """Half of the records have one key: no range holds much more than its share, and the order is whole."""
    rows = [(i, f"http://h{i % 40}.example/{i}", f"text {i}") for i in range(300)] + [(1000, "http://same/", "the same")] * 300
    pages = warc.dated(spark.createDataFrame(rows, PAGES).repartition(4))
    root = f"file://{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/warc-ranges"
    index = warc.capture_index(warc.write_archives(pages, root, 5_000), root, run_records=50, range_rows=30)
    sizes = index.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) >= 20 and max(sizes) < 150
    found = [(r["url_key"].encode(), r["captured_at"], r["page_id"]) for r in index.collect()]
    assert len(found) == 600 and found == sorted(found)


def test_one_very_long_page(spark):
    html = "<p>" + "long page é " * 1_500_000
    rows = [(1, "http://a/", html), (2, "http://b/", "x"), (3, "http://c/", html)]
    found = {r["page_id"]: r for r in warc.archive_and_index(warc.dated(spark.createDataFrame(rows, PAGES))).collect()}
    assert {p: r["payload_bytes"] for p, r in found.items()} == {1: len(html.encode()), 2: 1, 3: len(html.encode())}
    assert found[1]["refers_to"] == 3 and found[3]["record_type"] == "response"
    assert found[1]["payload_digest"] == hashlib.sha1(html.encode()).hexdigest()
