import zlib

import pytest
from pyspark.sql import functions as F

from freshet.llm import sharding
from tests.llm.conftest import DOCS, words


def check_law(rows, shards):
    """Slots are gapless per shard; gives the bytes of every shard."""
    sizes = [0] * shards
    for shard in range(shards):
        mine = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        sizes[shard] = sum(r["size"] for r in mine)
    return sizes


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows are one text."""
    rows = [(i, " ".join(words(i, 30)) if i % 3 else "the same text again", "en", "s", 0) for i in range(3000)]
    return spark.createDataFrame(rows, DOCS)


def test_sizes_are_near_equal_and_slots_gapless(skewed):
    rows = sharding.shard(skewed, shards=8).select("row.doc_id", "size", "shard", "slot").collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == 3000
    sizes = check_law(rows, 8)
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)


def test_order_follows_text_hash_and_only_splitters_part_equal_texts(skewed):
    placed = sharding.shard(skewed, shards=8).select(F.xxhash64("row.text").alias("h"), "shard", "slot")
    rows = placed.orderBy("shard", "slot").select(F.shiftrightunsigned("h", 1).alias("k")).collect()
    keys = [r["k"] for r in rows]
    assert keys == sorted(keys)
    homes = placed.groupBy("h").agg(F.countDistinct("shard").alias("n")).where("n > 1").count()
    assert homes <= 7


@pytest.mark.parametrize("cell_rows", [16, 100, 10_000])
def test_cell_size_does_not_change_the_result(skewed, cell_rows):
    def places(**options):
        return {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(skewed, 5, **options).select("row.doc_id", "shard", "slot").collect()}

    assert places(cell_rows=cell_rows, tolerance=0.0) == places(tolerance=0.0)


def test_splitters_are_the_nearest_boundaries(skewed):
    """Against a plain sort of all rows on the driver."""
    placed = sharding.shard(skewed, 6, tolerance=0.0).select("row.doc_id", "size", "shard", "slot")
    rows = sorted(placed.collect(), key=lambda r: (r["shard"], r["slot"]))
    edges, total = [0], sum(r["size"] for r in rows)
    for r in rows:
        edges.append(edges[-1] + r["size"])
    for shard in range(1, 6):
        begins = sum(1 for r in rows if r["shard"] < shard)
        assert abs(edges[begins] - total * shard / 6) == min(abs(e - total * shard / 6) for e in edges)


def test_awkward_rows(docs, clashing, no_docs):
    for frame in (docs, clashing):
        rows = sharding.shard(frame, 4).select("row.*", F.col("shard").alias("home"), F.col("slot").alias("place")).select("doc_id", "text", "home", "place").collect()
        assert len(rows) == docs.count()
    rows = sharding.shard(docs, 4).select("row.text", "size").collect()
    assert all(r["size"] == 8 + len((r["text"] or "").encode()) for r in rows)
    assert sharding.shard(no_docs, 4).count() == 0
    assert zlib.crc32(b"") == 0


@pytest.mark.parametrize(("wanted", "cell_rows"), [(24, 4_000_000), (24, 100), (7, 16)])
def test_rows_equal_in_all_columns_are_split(spark, wanted, cell_rows):
    """Half of the rows are one row; every shard still has its part, and no row is lost."""
    rows = [(i, " ".join(words(i, 12)), "en", "s", 1) for i in range(3000)] + [(-1, "the same row again and again", "en", "s", 1)] * 3000
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    placed = sharding.shard(docs, wanted, cell_rows=cell_rows)
    found = placed.select("row.*", "size", "shard", "slot").collect()
    sizes = check_law(found, wanted)
    total = sum(sizes)
    assert max(abs(s - total / wanted) for s in sizes) <= 2 * max(r["size"] for r in found) + 2 * sharding.TOLERANCE * total / wanted
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in rows)
    assert all(r["size"] == 8 + len(r["text"]) for r in found)


def test_equal_rows_travel_as_one(spark):
    """The group is counted before its shuffle: its exchange takes one row a task, not one a copy."""
    docs = spark.createDataFrame([(1, "x", "en", "s", 1)] * 4000, DOCS).repartition(4)
    placed = sharding.shard(docs, 4, cell_rows=100)
    assert {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()} == dict.fromkeys(range(4), 1000)
    assert sorted(r["slot"] for r in placed.where("shard = 2").collect()) == list(range(1000))
    assert placed.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).filter(bool).count() > 1


def test_rows_that_differ_in_a_map_only(spark):
    docs = spark.createDataFrame([(1, "x", {"k": i % 3}) for i in range(300)], "doc_id long, text string, m map<string,int>")
    rows = sharding.shard(docs, 5, cell_rows=16).select("row.m", "size", "shard", "slot").collect()
    check_law(rows, 5)
    assert sorted(r["m"]["k"] for r in rows) == sorted(i % 3 for i in range(300))


def test_no_python_in_the_plan(docs, capsys):
    sharding.shard(docs, 4).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Arrow" not in plan
